"""Column-expression builders. Everything here returns a ``Column`` built from
``pyspark.sql.functions`` and evaluated in the JVM. Higher-order functions (token scoring, keyword
matching, line filters) are interpreted per element outside whole-stage codegen; the lexicon lookup is
a scan of a literal map of about a hundred words per token, so far larger lexicons need a join."""

from avisflow.functions.keys import surrogate_key  # noqa: F401
from avisflow.functions.numeric import pg_round, percent, rank_key  # noqa: F401
