"""Column expressions for code lists and description text (TXT1-TXT10).

Every function takes and returns a ``Column`` built from JVM-side built-ins, so
it stays inside whole-stage codegen wherever it is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.common import as_col, quote_regex

# ---------------------------------------------------------------------------
# These must equal the source coding tables' conventions for
# results to match. Kept verbatim, in their natural order.
# ---------------------------------------------------------------------------

# Phrase removed from description fields before they go into a prompt.
CODIFY_PHRASE = " ; se o doente tem a doença, codifique-a"

# Ordered abbreviation expansion: "NE" first, then the chapter tags. Order
# matters because "NE" is replaced inside words too. Chapter (A) has no entry.
ABBREVIATIONS = [
    ("NE", "não especificada"),
    ("(B)", "por Sangue, órgãos hematopoiéticos e linfáticos"),
    ("(D)", "por Aparelho digestivo e Gastrenterologia"),
    ("(F)", "por Olhos e Oftalmologia"),
    ("(H)", "por Ouvidos e Otorrinolaringologia"),
    ("(K)", "por sistema cardiovascular e aparelho circulatório"),
    ("(L)", "por Sistema musculo-esquelético"),
    ("(N)", "por Sistema nervoso e Neurologia"),
    ("(P)", "por Piscologico e Psiquiátrico"),
    ("(R)", "por Aparelho respiratório e Penumologia"),
    ("(S)", "por Pele e Dermatologia"),
    ("(T)", "por Endócrino, metabólico e nutricional"),
    ("(U)", "por Aparelho urinário"),
    ("(W)", "por Gravidez e planeamento familiar"),
    ("(X)", "por Aparelho genital feminino (incluíndo mama)"),
    ("(Y)", "por por Aparelho genital masculino"),
    ("(Z)", "por por Problemas sociais "),
]

# System context sent with every synonym-generation prompt.
PROMPT_CONTEXT = (
    "Estou a fazer um processo de Data Augmentation e preciso de encontrar sinónimos para a "
    "seguinte doença ou problema de saúde em português de Portugal. Vou te dar as expressões que "
    "já tenho, encontra-me variações que sejam sinónimos ou outras formas de expressão similares . "
    "Dá-me entre 10 e 50 resultados. Devlove apenas a lista de expressões separadas por ';'"
)

# Pattern of a code embedded in free text: one capital letter and two digits.
EMBEDDED_CODE = r"(?U)\b[A-Z]\d{2}\b"


# ---------------------------------------------------------------------------


def parse_code_list(col) -> Column:
    """TXT1. ``"H54.0; H54.1"`` -> ``[H540, H541]``.

    Spaces and dots are removed literally, then the text is split on ``;`` or
    whitespace and empty pieces dropped. NULL stays NULL, ``""`` gives ``[]``.
    """
    c = as_col(col)
    squeezed = F.replace(F.replace(c, F.lit(" "), F.lit("")), F.lit("."), F.lit(""))
    parts = F.split(squeezed, r"(?U)[;\s]+")
    return F.filter(parts, lambda x: x != F.lit(""))


def join_list(col, sep: str = "; ") -> Column:
    """TXT3. Join an array with ``sep``; an empty or NULL array gives ``''``."""
    return F.coalesce(F.array_join(as_col(col), sep), F.lit(""))


def split_parts(col, sep: str = "; ") -> Column:
    """Array of the ``sep``-delimited parts, empty parts kept (limit -1)."""
    return F.split(as_col(col), quote_regex(sep), -1)


def clean_description(col) -> Column:
    """TXT4. Remove embedded codes, the fixed codify phrase, then tighten
    ``' ; '`` to ``'; '`` (in that order). NULL gives ``''``."""
    c = F.regexp_replace(as_col(col), EMBEDDED_CODE, "")
    c = F.replace(c, F.lit(CODIFY_PHRASE), F.lit(""))
    c = F.replace(c, F.lit(" ; "), F.lit("; "))
    return F.coalesce(c, F.lit(""))


def expand_abbreviations(col, mapping=None) -> Column:
    """TXT5. Ordered literal substitution (default: ``ABBREVIATIONS``)."""
    pairs = ABBREVIATIONS if mapping is None else list(mapping)
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), pairs, as_col(col))


def strip_final_dot(col) -> Column:
    """Remove exactly one trailing ``.`` (Java ``$`` would also match before a
    final newline, so no regex here)."""
    c = as_col(col)
    return F.when(c.endswith("."), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def parse_generated_list(col, sep: str = "; ") -> Column:
    """TXT7. Strip one final dot, split on ``sep``, de-duplicate."""
    return F.array_distinct(split_parts(strip_final_dot(col), sep))


def search_text(code, name, inclusion, crosswalk_text) -> Column:
    """TXT8. ``code name inclusion crosswalk`` with NULL inclusion as ``''``;
    a NULL name (or code / crosswalk text) keeps the result NULL."""
    return F.concat(as_col(code), F.lit(" "), as_col(name), F.lit(" "),
                    F.coalesce(as_col(inclusion), F.lit("")), F.lit(" "), as_col(crosswalk_text))


def rewrite_dash(col, anchored: bool = False) -> Column:
    """TXT9. Every ``-`` becomes ``A``; ``anchored=True`` only a leading one."""
    c = as_col(col)
    if anchored:
        return F.regexp_replace(c, "^-", "A")
    return F.replace(c, F.lit("-"), F.lit("A"))


def short_name(col) -> Column:
    """TXT10. Last ``/``-separated segment (model or run name)."""
    return F.substring_index(as_col(col), "/", -1)


def chapter(col) -> Column:
    """PRJ3. Chapter = first character of the code."""
    return F.substring(as_col(col), 1, 1)


def nullify_empty(col) -> Column:
    """``'' -> NULL`` (FIL6 normalisation)."""
    c = as_col(col)
    return F.nullif(c, F.lit(""))
