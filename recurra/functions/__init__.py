from recurra.functions.exprs import (  # noqa: F401
    dax_divide,
    month_diff,
    month_index,
    month_start,
    notebook_tenure_months,
    pg_round,
    ratio,
    subscription_end,
    tenure_days,
    to_money,
)
