"""Text expressions; all are JVM-side columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of the instruction block and the markers around it.
PROMPT_HEAD = (
    "Below is an instruction that describes a task, paired with an input that provides further context. "
    "Write a response that appropriately completes the request.\n\n"
)
PROMPT_INSTRUCTION = "Complete the story using a single sentence, based on the story beginning provided."
INPUT_MARK = "### Input:"
RESPONSE_MARK = "### Response:"
CHARSET_META = (
    '<head> <meta http-equiv="Content-type" content="text/html; charset=utf-8" /><meta charset="UTF-8" />'
)


def packed_part(col: str, index: int, sep: str = ",") -> Column:
    """The ``index``-th (from 1) number of a packed text such as ``"lon, lat"``."""
    return F.split_part(F.col(col), F.lit(sep), F.lit(index)).try_cast("float")


def join_words(cols: Sequence[str], null_policy: str = "strict") -> Column:
    """Columns joined by blanks; ``strict`` gives null on any null, ``skip`` leaves nulls out."""
    if null_policy == "skip":
        return F.concat_ws(" ", *cols)
    if null_policy != "strict":
        raise ValueError("null_policy is 'strict' or 'skip'")
    parts = [F.col(cols[0])]
    for c in cols[1:]:
        parts += [F.lit(" "), F.col(c)]
    return F.concat(*parts)


def prompt(col: str) -> Column:
    """Instruction block around a text."""
    head = f"{PROMPT_HEAD}### Instruction:\n{PROMPT_INSTRUCTION}\n\n{INPUT_MARK}\n"
    return F.concat(F.lit(head), F.col(col), F.lit(f"\n\n{RESPONSE_MARK} "))


def one_line(col: Column) -> Column:
    """Without line feeds, carriage returns and ``<br>``."""
    return F.regexp_replace(col, r"\n|\r|<br>", "")


def between_markers(col: Column, start: str = INPUT_MARK, end: str = RESPONSE_MARK) -> Column:
    """Text after the first ``start`` and before the first ``end``; null if either is missing."""
    a, b = F.instr(col, start), F.instr(col, end)
    begin = a + F.lit(len(start))
    return F.when((a > 0) & (b > 0), F.substring(col, begin, F.greatest(b - begin, F.lit(0))))


def after_marker(col: Column, mark: str = RESPONSE_MARK) -> Column:
    """Text after the first ``mark``; null if it is missing."""
    at = F.instr(col, mark)
    return F.when(at > 0, F.substring(col, at + F.lit(len(mark)), F.length(col)))


def sentences(col: Column) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by blanks or quotes."""
    return F.split(col, r'(?<=[.!?])[\s"]+')


def drop_sentences(col: Column, n: int = 4) -> Column:
    """Text without its first ``n`` sentences, the rest joined by single blanks."""
    s = sentences(col)
    return F.array_join(F.slice(s, n + 1, F.greatest(F.size(s), F.lit(1))), " ")


def find_codes(col: Column, label: str = "HS Code: ") -> Column:
    """Array of the numbers that follow ``label`` at a line's end."""
    return F.regexp_extract_all(col, F.lit(rf"{label}(\d+)\n"), F.lit(1))


def strip_tags(col: Column) -> Column:
    return F.regexp_replace(col, r"<.*?>", "")


def add_charset(col: Column) -> Column:
    return F.regexp_replace(col, "<head>", CHARSET_META)


def drop_images(col: Column) -> Column:
    return F.regexp_replace(col, r"<img alt.+?/>", "")


def drop_link_tags(col: Column) -> Column:
    return F.regexp_replace(col, r"<link href.+?/>", "")


def absolute_url(href: Column, base: Column) -> Column:
    """``href`` as it is when it has a scheme, otherwise ``base`` plus ``href``."""
    return F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), href).otherwise(F.concat(base, href))


def site_of(url: Column) -> Column:
    """Scheme and host of a URL."""
    return F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)


def path_segment(url: Column, marker: str, index: int = 1) -> Column:
    """The ``index``-th path segment after ``marker``."""
    return F.split_part(F.split_part(url, F.lit(marker), F.lit(2)), F.lit("/"), F.lit(index))


def range_label(lo: Column, hi: Column, unit: str) -> Column:
    """``lo-hi unit`` in whole numbers, or one number when both are equal."""
    whole = lambda c: c.cast("long").cast("string")
    return F.when(lo == hi, F.concat(whole(lo), F.lit(f" {unit}"))).otherwise(
        F.concat(whole(lo), F.lit("-"), whole(hi), F.lit(f" {unit}"))
    )
