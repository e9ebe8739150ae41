from __future__ import annotations

import contextlib
import io


def rows(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def unordered(df) -> list[tuple]:
    return sorted(rows(df), key=repr)


def plan(df, mode: str = "formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
