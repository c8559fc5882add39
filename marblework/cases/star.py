"""The flagship query."""

from marblework.plans.flagship import REGION_YEAR_SQL, region_year
from marblework.registry import query

query("flagship", REGION_YEAR_SQL)(region_year)
