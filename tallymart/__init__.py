"""E-commerce star schema, KPIs, business questions and insights as Spark jobs.

Every plan takes DataFrames plus a ``Rules`` value and returns a lazy
DataFrame.  Money stays DECIMAL end to end and every ratio is rounded half up
from exact sums, so results do not depend on partitioning.
"""
