"""Column-expression helpers. Everything here returns a ``Column``; nothing collects."""

from plantmetrics.functions.columns import (  # noqa: F401
    dec, hours_between, monday_of, trunc_hour, week_start,
)
from plantmetrics.functions.vectors import (  # noqa: F401
    cosine_expr, format_vector, parse_vector, vector_dims,
)
