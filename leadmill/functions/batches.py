"""Python run on Arrow batches inside tasks.

Sent to the executors by value, so they need no copy of the package.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# letters that Unicode does not decompose
PLAIN_LETTERS = str.maketrans(
    {
        "ø": "o", "Ø": "O", "ß": "ss", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "æ": "ae",
        "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "ð": "d", "Ð": "D", "ı": "i",
        "‘": "'", "’": "'", "ʻ": "'", "ʼ": "'", "–": "-", "—": "-",
    }
)


def fold(text: str) -> str:
    """Compatibility decomposition without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def to_ascii(text: str) -> str:
    return fold(text.translate(PLAIN_LETTERS)).encode("ascii", "ignore").decode()


def fold_batch(texts: pd.Series) -> pd.Series:
    return texts.map(fold, na_action="ignore")


def ascii_batch(texts: pd.Series) -> pd.Series:
    return texts.map(to_ascii, na_action="ignore")


def jaro_winkler_score(a: str, b: str) -> float:
    """Jaro similarity raised by up to four equal first characters."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = [False] * len(b)
    common = []
    for i, char in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == char:
                taken[j] = True
                common.append(char)
                break
    if not common:
        return 0.0
    other = [char for char, hit in zip(b, taken) if hit]
    swapped = sum(x != y for x, y in zip(common, other)) // 2
    m = len(common)
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro <= 0.7:
        return jaro
    start = 0
    while start < min(4, len(a), len(b)) and a[start] == b[start]:
        start += 1
    return jaro + start * 0.1 * (1 - jaro)


def damerau_levenshtein_distance(a: str, b: str) -> int:
    """Edits with transpositions, where swapped characters may be edited in between."""
    far = len(a) + len(b)
    table = {(-1, -1): far}
    for i in range(len(a) + 1):
        table[i, -1], table[i, 0] = far, i
    for j in range(len(b) + 1):
        table[-1, j], table[0, j] = far, j
    last_row: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        last_col = 0
        for j, y in enumerate(b, 1):
            row, col = last_row.get(y, 0), last_col
            table[i, j] = min(
                table[i - 1, j - 1] + (x != y),
                table[i, j - 1] + 1,
                table[i - 1, j] + 1,
                table[row - 1, col - 1] + (i - row - 1) + 1 + (j - col - 1),
            )
            if x == y:
                last_col = j
        last_row[x] = i
    return table[len(a), len(b)]


def damerau_levenshtein_score(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    return 1 - damerau_levenshtein_distance(a, b) / max(len(a), len(b))


def score_pairs(score: Callable[[str, str], float], left: pd.Series, right: pd.Series) -> pd.Series:
    """Score each distinct pair of a batch once; a pair with a gap has no score."""
    known: dict[tuple[str, str], float | None] = {}
    scores = []
    for a, b in zip(left, right):
        if (a, b) not in known:
            known[a, b] = None if a is None or b is None else score(a, b)
        scores.append(known[a, b])
    return pd.Series(scores, dtype="float64")


def jaro_winkler_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    return score_pairs(jaro_winkler_score, left, right)


def damerau_levenshtein_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    return score_pairs(damerau_levenshtein_score, left, right)
