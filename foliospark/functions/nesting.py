"""Nesting of brackets in long texts: depths by prefix sums, outside strings, in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_OPEN, _CLOSE = b"{[(", b"}])"
_STEP = np.zeros(256, np.int8)
_STEP[list(_OPEN)], _STEP[list(_CLOSE)] = 1, -1
_KIND = np.zeros(256, np.uint8)
for _k, (_a, _b) in enumerate(zip(_OPEN, _CLOSE, strict=True)):
    _KIND[_a] = _KIND[_b] = _k
QUOTE, BACKSLASH = 34, 92


def outside_strings(body: np.ndarray) -> np.ndarray:
    """Marks the bytes that stand in no double-quoted string; a quote after an odd run of backslashes is none."""
    slash = body == BACKSLASH
    place = np.arange(len(body))
    start = np.maximum.accumulate(np.where(~slash, place, -1))
    escaped = np.zeros(len(body), bool)
    escaped[1:] = slash[:-1] & ((place[:-1] - start[:-1]) % 2 == 1)
    quote = (body == QUOTE) & ~escaped
    return (np.cumsum(quote) - quote) % 2 == 0


def bracket_scan(text: str) -> tuple[int, int, bool]:
    """(depth at the end, least depth on the way, whether all brackets close in the order of their opening).

    The depth is a sum over prefixes, so that parts of a text could be scanned apart: sums add up, and
    the least prefix of two parts is the less of the first's and of the first's sum plus the second's.
    Brackets of one depth, in order, must be pairs of one kind.
    """
    body = np.frombuffer(text.encode(), np.uint8)
    at = np.flatnonzero((_STEP[body] != 0) & outside_strings(body)) if len(body) else np.zeros(0, np.int64)
    if not len(at):
        return 0, 0, True
    step, kind = _STEP[body[at]].astype(np.int64), _KIND[body[at]]
    depth = np.cumsum(step)
    least = min(0, int(depth.min()))
    if least < 0 or depth[-1] != 0:
        return int(depth[-1]), least, False
    by = np.argsort(np.where(step > 0, depth, depth + 1), kind="stable")
    pairs = kind[by].reshape(-1, 2)
    return 0, 0, bool((pairs[:, 0] == pairs[:, 1]).all())


def nesting(c: Column) -> Column:
    """Struct (balance, least, nested) of the brackets {[( of a text outside double-quoted strings; null for a null text."""

    @F.pandas_udf("balance int, least int, nested boolean")
    def scan(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([bracket_scan(t) if t is not None else (None, None, None) for t in texts], columns=["balance", "least", "nested"])

    return F.when(c.isNotNull(), scan(c))
