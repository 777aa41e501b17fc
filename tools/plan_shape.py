"""Print only the operator tree of a DataFrame's formatted plan."""

import contextlib
import io


def plan_shape(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n(1)")[0]
