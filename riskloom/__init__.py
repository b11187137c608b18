"""riskloom: credit-risk analytics as Spark DataFrame operators.

Loan-level and loan-month data stay Spark DataFrames end to end; every
operator returns a lazy DataFrame (or Column) so Catalyst can prune,
push down and fuse the whole chain.
"""

__version__ = "0.1.0"
