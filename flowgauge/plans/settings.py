"""Points in time and years the registered queries use (inside the test data's range)."""

import datetime as dt

from flowgauge.operators.refresh import Changes

AS_OF = "1998-06-15 07:30:00"  # local time, a Monday
TODAY = AS_OF[:10]
STATUS_AS_OF = "1998-06-15 17:10:00"
BASE_YEAR = 1997
ALLOCATE_START = "1997-06-01"
ALLOCATE_END = "1998-03-31"
HOURLY_SOURCE_YEAR = 1999
RUN_ID = "run-1"
RECORDED_AT = "1998-06-15 00:00:00"
#: Days of the sources that change before the stored year is refreshed.
CHANGES = Changes(facts=[dt.date(1998, 6, 12)], weather=[dt.date(1998, 7, 4)], events=[dt.date(1998, 8, 21), dt.date(1998, 8, 22)])
