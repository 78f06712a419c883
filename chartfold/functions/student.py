"""Two-sided Student-t tail probability from native expressions.

p = I_x(df/2, 1/2) with x = df / (df + t^2), the regularised incomplete beta
function, evaluated by its continued fraction (modified Lentz recurrence).
The gamma ratio in the prefactor comes from its asymptotic series after
shifting the argument up by 8, so nothing cancels for very large df.
Everything is a SQL expression on the few fitted rows: the cost does not
depend on how many rows were fitted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Iterations of the continued fraction; 60 were enough from df = 1 to 1e11.
_STEPS = 150


def _let(body: str, **values: str) -> str:
    """Bind `values` to the fields of a struct `v` around `body`.

    Each is then evaluated once, where plain text would repeat it at every use.
    """
    fields = ", ".join(f"'{name}', {text}" for name, text in values.items())
    return f"get(transform(array(named_struct({fields})), v -> {body}), 0)"


# ln(gamma(a + 1/2) / gamma(a)) by its series at z = a + 8, shifted back to a.
_LOG_GAMMA_HALF_STEP = (
    "(ln(v.a + 8) / 2 - 1 / (8 * (v.a + 8)) + 1 / (192 * pow(v.a + 8, 3))"
    " - 1 / (640 * pow(v.a + 8, 5)) + 17 / (14336 * pow(v.a + 8, 7))"
    " + ln(aggregate(sequence(0, 7), 1D, (q, i) -> q * (v.a + i) / (v.a + i + 0.5D))))"
)

# Even and odd terms alternate: k = 2, 3, 4, 5, ... has m = 1, 1, 2, 2, ...
_TERM = (
    "if(k % 2 = 0,"
    " (k div 2) * (v.b - (k div 2)) * v.x / ((v.a - 1 + 2 * (k div 2)) * (v.a + 2 * (k div 2))),"
    " -(v.a + (k div 2)) * (v.a + v.b + (k div 2)) * v.x"
    " / ((v.a + 2 * (k div 2)) * (v.a + 1 + 2 * (k div 2))))"
)

_BETA_FRACTION = (
    f"aggregate(sequence(2, {2 * _STEPS + 1}),"
    " named_struct('c', 1D, 'd', 1 / (1 - (v.a + v.b) * v.x / (v.a + 1)),"
    " 'h', 1 / (1 - (v.a + v.b) * v.x / (v.a + 1))),"
    " (s, k) -> get(transform("
    f"array(named_struct('c', 1 + {_TERM} / s.c, 'd', 1 / (1 + {_TERM} * s.d))),"
    " n -> named_struct('c', n.c, 'd', n.d, 'h', s.h * n.c * n.d)), 0)).h"
)

# The fraction converges fast on one side of the mean only; on the other side
# (`swap`) the arguments change places and the result is 1 - value.
_TAIL = _let(
    _let(
        "if(v.swap, 1 - v.part, v.part)",
        swap="v.swap",
        part=f"exp(v.ln_scale) * {_BETA_FRACTION} / v.a",
    ),
    swap="v.swap",
    ln_scale=f"{_LOG_GAMMA_HALF_STEP} - ln(pi()) / 2 - v.a * log1p(v.u) + ln(v.u / (1 + v.u)) / 2",
    a="if(v.swap, 0.5D, v.a)",
    b="if(v.swap, v.a, 0.5D)",
    x="if(v.swap, v.u, 1D) / (1 + v.u)",
)


def two_sided_p_sql(t: str, df: str) -> str:
    """SQL text of P(|T| >= |t|) for T with `df` degrees of freedom.

    `t` and `df` are SQL expressions; the result is NULL unless df >= 1.
    """
    with_side = _let(
        f"case when v.u > 0 then {_TAIL} when v.u = 0 then 1D end",
        a="v.a",
        u="v.u",
        swap="1 / (1 + v.u) >= (v.a + 1) / (v.a + 2.5D)",
    )
    return _let(
        with_side,
        a=f"cast({df} as double) / 2",
        u=f"if({df} >= 1, ({t}) * ({t}) / cast({df} as double), null)",
    )


def two_sided_p(t: str, df: str) -> Column:
    return F.expr(two_sided_p_sql(t, df))
