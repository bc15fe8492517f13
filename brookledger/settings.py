"""Run settings shared by all jobs."""

from __future__ import annotations

import datetime as dt

# "Now" is always passed in, so a rerun gives the same rows. The default lies
# after every date in the test tables, which keeps all day counts positive.
DEFAULT_AS_OF = dt.datetime(2028, 1, 1)
