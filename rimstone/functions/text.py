"""Text columns: trimming, keys, case changes and path parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed value: a capital that follows a word character starts a new word.
WORD_BREAK = r"(\w)([A-Z])"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """The value as text without leading and trailing spaces."""
    return F.trim(_col(c).cast("string"))


def hash_key(c: Column | str) -> Column:
    """Surrogate key of an id: SHA-256 as lower-case hex; NULL stays NULL."""
    return F.sha2(_col(c).cast("string"), 256)


def snake(c: Column | str) -> Column:
    """Snake case of a text column."""
    broken = F.regexp_replace(_col(c), "(?U)" + WORD_BREAK, "$1 $2")
    return F.lower(F.regexp_replace(broken, r"(?U)\s", "_"))


def snake_names(names: Sequence[str]) -> list[str]:
    """The names as `snake` gives them; Spark folds the expression, so no task runs."""
    if not names:
        return []
    given = F.array(*[F.lit(n) for n in names])
    return SparkSession.active().sql("select 1").select(F.transform(given, snake)).first()[0]


def kebab(prefix: Column | str, *suffixes: Column | str) -> Column:
    """Source name as a column: prefix kept, suffixes lower-cased, spaces turned into hyphens."""
    tail = F.lower(F.replace(F.concat_ws("-", *[_col(s).cast("string") for s in suffixes]), F.lit(" "), F.lit("-")))
    return F.concat_ws("-", _col(prefix), tail)


def path_parts(c: Column | str) -> Column:
    return F.filter(F.split(_col(c), "/"), lambda part: part != "")


def path_tail(c: Column | str, n: int = 2) -> Column:
    """Last `n` parts of a path joined by slashes; the whole path when it has fewer."""
    parts = path_parts(c)
    start = F.greatest(F.size(parts) - n + 1, F.lit(1))
    return F.concat_ws("/", F.slice(parts, start, n))


def last_part(c: Column | str) -> Column:
    """Text after the last slash."""
    return F.substring_index(_col(c), "/", -1)


def file_stem(c: Column | str, suffix: str = ".parquet") -> Column:
    """File name without its suffix."""
    return F.replace(last_part(c), F.lit(suffix), F.lit(""))
