"""arbiter: feedback-driven decision analytics on Spark DataFrames.

Session quality reports are grouped, aggregated per (group, option) with sliding windows
or exponential discounting, turned into decisions (greedy, epsilon-greedy, discounted UCB,
resetting UCB), served back to request tables, routed between clusters and evaluated offline.
Every operator is a ``DataFrame -> DataFrame`` function built from Catalyst expressions.
"""

__version__ = "0.1.0"
