"""Parameters that stand for the clock and other settings in the registered queries."""

from datetime import date, datetime

AS_OF = datetime(2024, 1, 30, 12, 0, 0)
DAY = date(1998, 7, 1)
TTL_SECONDS = 3600
RECENT_ROWS = 10
ENTRY_TTL_SECONDS = 2 * 86400
