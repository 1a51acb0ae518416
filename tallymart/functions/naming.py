"""Column names as sources spell them, and as tables need them."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame


def plain_name(name: str) -> str:
    """Lower-case ASCII letters, digits and single underscores.

    >>> plain_name("Código Departamento")
    'codigo_departamento'
    """
    letters = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    return "_".join(re.findall(r"[a-z0-9]+", letters.lower()))


def plain_names(names: Iterable[str]) -> list[str]:
    """``plain_name`` over a header; two names that fall together are an error."""
    names = list(names)
    plain = [plain_name(n) for n in names]
    clashes = {p for p, n in Counter(plain).items() if n > 1}
    if clashes:
        raise ValueError(
            "column names fall together: "
            + ", ".join(f"{n!r} -> {p!r}" for n, p in zip(names, plain) if p in clashes)
        )
    return plain


def find_column(df: DataFrame, name: str) -> str | None:
    """The column as the frame spells it, whatever the case asked for."""
    wanted = name.lower()
    return next((c for c in df.columns if c.lower() == wanted), None)


def present(df: DataFrame, names: Mapping[str, str]) -> dict[str, str]:
    """The part of an old-to-new mapping whose old names the frame has."""
    found = {find_column(df, old): new for old, new in names.items()}
    found.pop(None, None)
    return found
