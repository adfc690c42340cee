"""Text, metadata and links of HTML pages by regular expression.

Whatever is not closed (a comment, a script, a title, a tag, a quote) runs to the end of
the page.  With that, and with possessive groups, which Java repeats in a loop, a hostile
page costs neither quadratic time nor deep recursion.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.text import as_column, strip_text
from folioscope.staging import bind

_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# Named characters come from the standard library; the codes 128 to 159 mean Windows-1252.
_NAMED = {name[:-1]: char for name, char in html5.items() if name.endswith(";")} | {
    f"#{code}": bytes([code]).decode("cp1252", errors="ignore") or chr(code)
    for code in range(128, 160)
}
# A map is searched entry by entry, so names are looked up by their first characters first.
_HEAD_CHARS = 1
# The names worth a look before the table.
_FREQUENT = ("amp", "lt", "gt", "quot", "nbsp")

_HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
)
_HEAD = r"(?is)<head\b.*?(?:</head\s*>|(?=<body\b)|\z)|<title\b.*?(?:</title\s*>|\z)"
# A '>' inside a quoted value does not end a tag.
_TAG_REST = (
    r"(?:[^>=]++|=\s*+\"[^\"]*+(?:\"|\z)|=\s*+'[^']*+(?:'|\z)|=)*+(?:>|\z)"
)
_BLOCK_TAG = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|"
    r"figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|option|p|pre|section|table|"
    r"tbody|td|tfoot|th|thead|title|tr|ul)\b"
) + _TAG_REST
_ANY_TAG = r"</?[A-Za-z!?]" + _TAG_REST
_TITLE = r"(?is)<title\b[^>]*>(.*?)(?:</title|\z)"

_ATTRIBUTE = r"([^\s=>/\"'][^\s=>/]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?"
_QUOTED = r"^(?:\"[^\"]*\"|'[^']*')\z"


def _tag(name: str) -> str:
    return rf"(?is)<{name}(?=[\s/]){_TAG_REST}"


def _attribute_value(tag: Column, name: str) -> Column:
    """An attribute as it is written; '' without a value, null when the tag lacks it."""
    inner = F.regexp_replace(tag, r"^<\w+", "")
    names = F.transform(F.regexp_extract_all(inner, F.lit(_ATTRIBUTE), F.lit(1)), F.lower)
    values = F.regexp_extract_all(inner, F.lit(_ATTRIBUTE), F.lit(2))
    value = F.get(values, (F.array_position(names, name) - 1).cast("int"))
    return bind(
        value,
        lambda v: F.when(v.rlike(_QUOTED), F.substring(v, 2, F.length(v) - 2)).otherwise(v),
    )


def _look_up(table: Column, name: Column) -> Column:
    return F.try_element_at(F.try_element_at(table, F.left(name, F.lit(_HEAD_CHARS))), name)


def _decode_entity(entity: Column, table: Column) -> Column:
    body = F.substring(entity, 2, 40)
    body = F.left(body, F.length(body) - 1)
    hexadecimal = F.lower(body).startswith("#x")
    digits = F.when(hexadecimal, F.conv(F.substring(body, 3, 8), 16, 10)).otherwise(
        F.substring(body, 2, 8)
    )
    code = digits.cast("int")
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    utf32 = F.unhex(F.lpad(F.hex(code), 8, "0"))
    char = (
        F.when(code.between(128, 159), _look_up(table, F.concat(F.lit("#"), code)))
        .when(valid, F.decode(utf32, "UTF-32"))
        .otherwise("\ufffd")
    )
    named = F.coalesce(_look_up(table, body), entity)
    frequent = F.when(body.startswith("#"), char)
    for name in _FREQUENT:
        frequent = frequent.when(body == name, _NAMED[name])
    return frequent.otherwise(named)


def decode_entities(text: Column | str) -> Column:
    """Replace ``&name;``, ``&#n;`` and ``&#xn;`` once; unknown names stay."""
    heads: dict[str, dict[str, str]] = {}
    for name, char in _NAMED.items():
        heads.setdefault(name[:_HEAD_CHARS], {})[name] = char
    kind = "map<string,map<string,string>>"
    table = F.from_json(F.lit(json.dumps(heads, ensure_ascii=False)), kind)

    def joined(before: Column, entity: Column) -> Column:
        decoded = F.when(entity.isNull(), "").otherwise(_decode_entity(entity, table))
        return F.concat(before, decoded)

    def decoded(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(0))
        whole = F.array_join(F.zip_with(F.split(t, _ENTITY), found, joined), "")
        return F.when(t.contains("&"), whole).otherwise(t)

    return bind(as_column(text), decoded)


def html_text(html: Column | str) -> Column:
    """Visible text of the body: block tags become line ends, other tags vanish."""
    visible = F.regexp_replace(as_column(html), _HIDDEN, "")
    body = F.regexp_replace(visible, _HEAD, "")
    lines = F.regexp_replace(body, _BLOCK_TAG, "\n")
    return strip_text(decode_entities(F.regexp_replace(lines, _ANY_TAG, "")))


def html_title(html: Column | str) -> Column:
    """The title, '' when there is none."""
    title = F.regexp_extract(as_column(html), _TITLE, 1)
    return strip_text(decode_entities(title))


def html_language(html: Column | str) -> Column:
    """The language the page names, '' when it names none."""
    tag = F.regexp_extract(as_column(html), _tag("html"), 0)
    return F.coalesce(_attribute_value(tag, "lang"), F.lit(""))


def html_meta(html: Column | str, name: str) -> Column:
    """The content of ``<meta name=...>``, '' when there is none."""
    tags = F.regexp_extract_all(as_column(html), F.lit(_tag("meta")), F.lit(0))
    named = F.filter(
        tags, lambda t: F.coalesce(F.lower(_attribute_value(t, "name")) == name, F.lit(False))
    )
    content = _attribute_value(F.try_element_at(named, F.lit(1)), "content")
    return F.coalesce(decode_entities(content), F.lit(""))


def html_links(html: Column | str) -> Column:
    """The href of every ``<a href=...>``, in document order; comments and scripts hide theirs."""
    visible = F.regexp_replace(as_column(html), _HIDDEN, "")
    tags = F.regexp_extract_all(visible, F.lit(_tag("a")), F.lit(0))
    hrefs = F.transform(tags, lambda t: _attribute_value(t, "href"))
    return F.transform(F.filter(hrefs, lambda h: h.isNotNull()), decode_entities)
