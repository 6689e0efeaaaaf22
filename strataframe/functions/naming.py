"""Column-name hygiene.  Schema-only work on the driver; no row is touched."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame


def _plain_ascii(name: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", name) if ord(ch) < 128)


def snake_case(name: str) -> str:
    """``"Número Correlativo"`` -> ``numero_correlativo``; splits at lower-to-upper steps."""
    words = re.findall(r"[A-Z]+[a-z0-9]*|[a-z0-9]+", _plain_ascii(name))
    return "_".join(words).lower()


def storage_safe(name: str) -> str:
    """Replace each character that table formats refuse in a column name."""
    return name.translate(str.maketrans({ch: "_" for ch in " ,;{}()\n\t="}))


def punctuation_free(name: str) -> str:
    """Lower case; every punctuation mark and blank becomes an underscore."""
    trimmed = name.lower().strip()
    return "".join(ch if ch.isalnum() or ch == "_" or (ch.isspace() and ch != " ") else "_" for ch in trimmed)


def separator_free(name: str) -> str:
    """Lower case; blanks, hyphens and slashes become underscores."""
    return name.lower().strip().translate(str.maketrans(" -/", "___"))


NAME_STYLES = {
    "snake": snake_case,
    "storage": storage_safe,
    "punctuation": punctuation_free,
    "separator": separator_free,
}


def rename_all(df: DataFrame, style: str = "snake") -> DataFrame:
    """Apply a naming style to all columns; a clash between two names is an error."""
    names = [NAME_STYLES[style](c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)


def drop_matching(df: DataFrame, *names: str, pattern: str | None = None) -> DataFrame:
    """Drop columns by name and, ignoring case, by regular expression."""
    doomed = [c for c in df.columns if c in names or (pattern and re.search(pattern, c, re.IGNORECASE))]
    return df.drop(*doomed)
