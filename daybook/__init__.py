"""Daily customer-loyalty measures as plain Spark DataFrame code."""

from daybook.config import Config
from daybook.sources.tables import Tables
from daybook.plans.daily import daily

__all__ = ["Config", "Tables", "daily"]
