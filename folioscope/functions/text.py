"""Text scalars."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that str.isspace() accepts.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WHITESPACE_CLASS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"
LINE_BREAK = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"

# No limit: whole documents go into prompts unless the caller sets one.
DEFAULT_CONTEXT_CHARS = None


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_text(text: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def remove_blank_lines(text: Column | str) -> Column:
    """Keep the lines that hold more than whitespace; null gives ''."""
    lines = F.split(as_column(text), LINE_BREAK)
    kept = F.filter(lines, lambda line: strip_text(line) != "")
    return F.coalesce(F.array_join(kept, "\n"), F.lit(""))


def collapse_newlines(text: Column | str) -> Column:
    """Turn each pair of newlines into one, in a single pass from the left."""
    return F.replace(as_column(text), F.lit("\n\n"), F.lit("\n"))


def truncate_chars(text: Column | str, limit: int | None = DEFAULT_CONTEXT_CHARS) -> Column:
    return as_column(text) if limit is None else F.substring(as_column(text), 1, limit)


def was_truncated(text: Column | str, limit: int | None = DEFAULT_CONTEXT_CHARS) -> Column:
    return F.lit(False) if limit is None else F.length(as_column(text)) > limit


def content_length(text: Column | str) -> Column:
    """Length in code points."""
    return F.length(as_column(text)).cast("bigint")


def base_name(path: Column | str) -> Column:
    return F.substring_index(as_column(path), "/", -1)


def dir_name(path: Column | str) -> Column:
    """Everything before the last '/', without trailing slashes unless it is all slashes."""
    path = as_column(path)
    head = F.left(path, F.length(path) - F.length(base_name(path)))
    bare = F.rtrim(head, F.lit("/"))
    return F.when(bare == "", head).otherwise(bare)


def default_empty(value: Column | str) -> Column:
    return F.coalesce(as_column(value), F.lit(""))


def exit_predicate(text: Column | str, mode: str = "strip") -> Column:
    """Is this turn the word that ends a conversation?"""
    text = as_column(text)
    if mode == "strip":
        return F.lower(strip_text(text)) == "exit"
    if mode == "exact":
        return F.lower(text) == "exit"
    if mode == "none":
        return F.lit(False)
    raise ValueError(f"unknown exit mode {mode!r}")


def render_template(template: str, **values: Column | str) -> Column:
    """Fill ``{name}`` placeholders in one pass; filled text is never expanded again.

    A placeholder without a value is an error raised before any job starts.  Strings in
    ``values`` are literals, Columns are taken as they are.
    """
    parts: list[Column] = []
    for literal, name, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if name not in values:
            raise KeyError(f"the template names an unknown placeholder {{{name}}}")
        if spec or conversion:
            raise ValueError(f"placeholder {{{name}}} must be plain")
        value = values[name]
        parts.append(F.lit(value) if isinstance(value, str) else value)
    return F.concat(*parts) if parts else F.lit("")
