"""Text expressions, Column -> Column, all JVM-side unless the name says otherwise.

Code points are counted, not bytes. White space is what Python's str.strip() and str.split() take for white space; Java's
\\s is narrower, so the class is spelled out. Null stays null everywhere.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space of the Unicode standard as Python sees it, for Java and RE2 alike.
WS = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
IMAGE = "<image>"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"[{WS}]+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return strip(F.regexp_replace(c, f"[{WS}]+", " "))


def question_text(c: Column) -> Column:
    """Prompt without image tokens, stripped; the form used in sample keys."""
    return strip(F.replace(c, F.lit(IMAGE), F.lit("")))


def strip_image_token(c: Column) -> Column:
    """Prompt for training rows: the line break after an image token goes with it."""
    return strip(F.replace(F.replace(c, F.lit(IMAGE + "\n"), F.lit("")), F.lit(IMAGE), F.lit("")))


def sample_key(image: Column, question: Column) -> Column:
    return F.concat(image, F.lit("|"), question)


def flat_path(c: Column) -> Column:
    """Forward slashes only, without doubled slashes and '.' steps."""
    p = F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), "/+", "/")
    return F.regexp_replace(F.regexp_replace(p, r"(?:/\.)+(?=/|$)", ""), r"^(?:\./)+", "")


def resolve_path(c: Column, root: str = "") -> Column:
    """An absolute path without '.' and '..' steps; relative paths stand under `root`, and '..' above the top stays there."""
    p = flat_path(c)
    p = F.when(p.rlike("^(?:/|[A-Za-z]:/|[a-z]+:/)"), p).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), p)) if root else p
    steps = F.aggregate(
        F.split(p, "/"), F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc).when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc)).otherwise(F.concat(acc, F.array(x))),
    )
    return F.when(F.contains(p, F.lit("/.")), F.array_join(steps, "/")).otherwise(p)


def remap_image(c: Column, old: str, new: str) -> Column:
    """Move a path from one root to another by whole steps; a path that is not under `old`, or an empty `new`, stays as it is."""
    if not new:
        return c
    root, target = old.replace("\\", "/").rstrip("/"), new.replace("\\", "/").rstrip("/")
    p = flat_path(c)
    return F.when(p == root, target).when(p.startswith(root + "/"), F.concat(F.lit(target), F.substring(p, len(root) + 1, 1 << 30))).otherwise(c)


def parent_folder(c: Column, up: int = 1) -> Column:
    """The folder `up` steps above the file, or '' if the path is shorter."""
    return F.coalesce(F.get(F.reverse(F.split(c, "/")), F.lit(up)), F.lit(""))


def folder_label(c: Column) -> Column:
    return F.lower(F.replace(parent_folder(c), F.lit("_"), F.lit(" ")))


def stem(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, r"([^/]*)$", 1), r"\.[^.]*$", "")


#: Fixed value: the file names of pictures before and after an event.
PRE_POST = r"^(.*)_(\d+)_(pre|post)_disaster"


def event_of(c: Column) -> Column:
    return F.regexp_extract(stem(c), PRE_POST, 1)


def event_image_of(c: Column) -> Column:
    return F.regexp_extract(stem(c), PRE_POST, 2)


def event_status_of(c: Column) -> Column:
    return F.regexp_extract(stem(c), PRE_POST, 3)


def cjk_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[\x{4E00}-\x{9FFF}]"))


def cyrillic_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[\x{0400}-\x{04FF}]"))


def mojibake_count(c: Column) -> Column:
    """Private-use code points and the usual trace of a misread byte order mark."""
    return F.regexp_count(c, F.lit(r"[\x{9518}\x{E000}-\x{F8FF}]"))


def url_quote(c: Column) -> Column:
    """Percent-encoded path; slashes stay."""
    return F.replace(F.replace(F.url_encode(c), F.lit("%2F"), F.lit("/")), F.lit("+"), F.lit("%20"))


def mime_type(c: Column) -> Column:
    """Type of a picture by its ending, image/jpeg if unknown."""
    p = F.lower(c)
    return F.when(p.endswith(".png"), "image/png").when(p.endswith(".webp"), "image/webp").when(p.endswith(".gif"), "image/gif").when(p.endswith(".bmp"), "image/bmp").otherwise("image/jpeg")


def natural_key(c: Column, width: int = 20) -> Column:
    """A string that sorts digits by value and letters without case."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike(r"^\d"), F.lpad(F.regexp_replace(x, r"^0+(?=\d)", ""), width, "0")).otherwise(x)), "")


def lookup(c: Column, table: Mapping[str, str]) -> Column:
    """Value of a small literal dictionary, the key itself where it has none."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


@F.pandas_udf(StringType())
def flatten_content(c: pd.Series) -> pd.Series:
    """Text of dynamic message content given as JSON: null gives '', a string is stripped, a list joins the text (or else the
    content) of its blocks by line ends, nested lists likewise; anything else stays as written. Recursive, hence Python."""

    def block(x) -> str:
        if isinstance(x, dict):
            x = x.get("text") or x.get("content") or ""
        if isinstance(x, list):
            return joined(x)
        return str(x).strip() if x not in (None, "") else ""

    def joined(xs: list) -> str:
        return "\n".join(t for t in map(block, xs) if t).strip()

    def one(s) -> str:
        if not isinstance(s, str):
            return ""
        try:
            x = json.loads(s)
        except ValueError:
            return s.strip()
        if x is None:
            return ""
        return joined(x) if isinstance(x, list) else x.strip() if isinstance(x, str) else s.strip()

    return pd.Series([one(s) for s in c], dtype=object)
