"""URL parts, relative links, crawl scope and the file a URL is saved under.

Expressions that need several parts of a URL are staged as columns, so each regular
expression runs once per row.
"""

from __future__ import annotations

from urllib.parse import uses_relative

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import as_column
from folioscope.staging import bind, let

_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"
_CONTROL_OR_BLANK = "".join(chr(i) for i in range(0x21))

# Schemes whose links can be relative.
RELATIVE_SCHEMES = tuple(uses_relative)

HTML_EXTENSIONS = (".html", ".htm", "")
PDF_EXTENSION = ".pdf"


def clean_url(url: Column | str) -> Column:
    """Drop leading control characters and blanks, and tabs and line ends anywhere."""
    return F.translate(F.ltrim(as_column(url), F.lit(_CONTROL_OR_BLANK)), "\t\r\n", "")


def url_scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(as_column(url), rf"^({_SCHEME}):", 1))


def url_authority(url: Column | str) -> Column:
    """Host with user and port when they are given."""
    return F.regexp_extract(as_column(url), rf"^(?:{_SCHEME}:)?//([^/?#]*)", 1)


def _path_and_params(url: Column) -> Column:
    before_query = F.substring_index(fetch_key(url), "?", 1)
    return F.regexp_replace(before_query, rf"^(?:{_SCHEME}:)?(?://[^/]*)?", "")


def _after(text: Column, mark: str) -> Column:
    """What follows the first ``mark``, '' without one."""
    rest = F.substring(text, F.instr(text, mark) + 1, F.length(text))
    return F.when(text.contains(mark), rest).otherwise("")


def url_path(url: Column | str) -> Column:
    """The path without the ``;parameters`` of its last segment."""
    path = _path_and_params(as_column(url))
    return F.when(path.contains(";"), F.regexp_replace(path, r";[^/]*\z", "")).otherwise(path)


def url_params(url: Column | str) -> Column:
    url = as_column(url)
    params = F.regexp_extract(_path_and_params(url), r";([^/]*)\z", 1)
    return F.when(url.contains(";"), params).otherwise("")


def url_query(url: Column | str) -> Column:
    return _after(fetch_key(url), "?")


def url_fragment(url: Column | str) -> Column:
    return _after(as_column(url), "#")


def fetch_key(url: Column | str) -> Column:
    """What is sent to a server: the URL without its fragment."""
    return F.substring_index(as_column(url), "#", 1)


def url_extension(path: Column | str) -> Column:
    """The lower-cased extension of a path; leading dots start a name, not an extension."""
    return F.lower(path_extension(path))


def path_extension(path: Column | str) -> Column:
    name = F.ltrim(F.substring_index(as_column(path), "/", -1), F.lit("."))
    last = F.concat(F.lit("."), F.substring_index(name, ".", -1))
    return F.when(name.contains("."), last).otherwise("")


URL_PARTS = {
    "scheme": url_scheme,
    "authority": url_authority,
    "path": url_path,
    "params": url_params,
    "query": url_query,
    "fragment": url_fragment,
}

BASE_PARTS = ("scheme", "authority", "path", "params", "query")


def with_url_parts(df: DataFrame, url: str, prefix: str = "", parts=tuple(URL_PARTS)) -> DataFrame:
    return let(df, {prefix + part: URL_PARTS[part](url) for part in parts})


def _unsplit(scheme, authority, path, params, query, fragment) -> Column:
    rooted = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    bare = F.when(
        path.startswith("//") | ((scheme != "") & ((path == "") | path.startswith("/"))),
        F.concat(F.lit("//"), path),
    ).otherwise(path)

    def part(mark: str, value: Column, after: bool = False) -> Column:
        shown = F.concat(value, F.lit(mark)) if after else F.concat(F.lit(mark), value)
        return F.when(value != "", shown).otherwise("")

    return F.concat(
        part(":", scheme, after=True),
        F.when(authority != "", F.concat(F.lit("//"), authority, rooted)).otherwise(bare),
        part(";", params),
        part("?", query),
        part("#", fragment),
    )


def _segments(base_path: Column, path: Column) -> Column:
    """Segments of a non-empty relative path behind the folder of the page, dots kept."""
    base_parts = F.split(base_path, "/")
    folder = F.when(base_path.endswith("/") | (base_path == ""), base_parts).otherwise(
        F.slice(base_parts, 1, F.size(base_parts) - 1)
    )
    return F.when(path.startswith("/"), F.split(path, "/")).otherwise(
        F.concat(folder, F.split(path, "/"))
    )


def _laid(base_path: Column, path: Column) -> Column:
    """A relative path written behind the folder of the page, as a text."""
    folder = F.left(base_path, F.length(base_path) - F.length(F.substring_index(base_path, "/", -1)))
    return F.when(path.startswith("/"), path).otherwise(
        F.concat(F.when(base_path == "", "/").otherwise(folder), path)
    )


def _tidy(base_path: Column, path: Column, laid: Column) -> Column:
    """The path that a link means; ``laid`` is that path unless it has segments to drop.

    Only paths that may have such segments are taken apart.
    """
    rooted = path.startswith("/")
    odd = laid.startswith(".") | laid.contains("/.") | (~rooted & laid.contains("//"))
    segments = _segments(base_path, path)
    kept = F.when(rooted, segments).otherwise(_without_empty(segments))

    def joined(parts: Column) -> Column:
        dotted = F.exists(parts, lambda s: s.isin(".", ".."))
        return F.array_join(F.when(dotted, _without_dots(parts)).otherwise(parts), "/")

    whole = bind(kept, joined)
    return F.when(odd, whole).otherwise(laid)


def _without_empty(segments: Column) -> Column:
    """Drop empty segments except the first and the last."""
    last = F.size(segments) - 1
    return F.filter(segments, lambda s, i: (s != "") | (i == 0) | (i == last))


def _without_dots(segments: Column) -> Column:
    walked = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    open_end = F.element_at(segments, -1).isin(".", "..")
    return F.concat(walked, F.when(open_end, F.array(F.lit(""))).otherwise(F.array()))


def with_base_parts(pages: DataFrame, base: str) -> DataFrame:
    """Add the parts of a page's URL that resolving its links needs, once per page."""
    return with_url_parts(pages, base, "_b_", BASE_PARTS)


def resolve_links(df: DataFrame, base: str, href: str, out: str) -> DataFrame:
    """Add ``out``: the absolute URL that ``href`` means on the page ``base``.

    The columns of ``with_base_parts`` are used up when they are there and made otherwise.
    """
    c = F.col
    kept = [name for name in df.columns if name not in {f"_b_{part}" for part in BASE_PARTS}]
    if len(kept) == len(df.columns):
        df = with_base_parts(df, base)
    staged = let(df, {"_href": clean_url(href)})
    staged = with_url_parts(staged, "_href", "_h_")

    scheme = F.when(c("_h_scheme") != "", c("_h_scheme")).otherwise(c("_b_scheme"))
    foreign = (scheme != c("_b_scheme")) | ~scheme.isin(*RELATIVE_SCHEMES)
    # How much of the link is given: nothing, a whole URL, an authority, no path, or a path.
    form = (
        F.when(c(href) == "", "page")
        .when(foreign, "foreign")
        .when(c("_h_authority") != "", "authority")
        .when((c("_h_path") == "") & (c("_h_params") == ""), "same")
        .otherwise("path")
    )
    laid = _laid(c("_b_path"), c("_h_path"))
    staged = let(staged, {"_scheme": scheme, "_form": form, "_laid": laid})
    staged = let(
        staged,
        {"_merged": F.when(c("_form") == "path", _tidy(c("_b_path"), c("_h_path"), c("_laid")))},
    )
    same, given = c("_form") == "same", c("_form") == "authority"
    staged = let(
        staged,
        {
            "_authority": F.when(given, c("_h_authority")).otherwise(c("_b_authority")),
            "_path": F.when(given, c("_h_path"))
            .when(same, c("_b_path"))
            .when(c("_merged") == "", "/")
            .otherwise(c("_merged")),
            "_params": F.when(same, c("_b_params")).otherwise(c("_h_params")),
            "_query": F.when(same & (c("_h_query") == ""), c("_b_query")).otherwise(c("_h_query")),
        },
    )
    joined = _unsplit(
        c("_scheme"), c("_authority"), c("_path"), c("_params"), c("_query"), c("_h_fragment")
    )
    resolved = F.when(c("_form") == "page", c(base)).when(c("_form") == "foreign", c(href))
    return let(staged, {out: resolved.otherwise(joined)}).select(*kept, out)


def in_scope(
    authority: Column, path: Column, start_authority: str, start_path: str, segment_aligned=False
) -> Column:
    """Same host, and a path that starts with the start path (its trailing '/' removed).

    The plain prefix test also admits ``/foobar`` below ``/foo``; ``segment_aligned``
    admits only whole path segments.
    """
    prefix = start_path.rstrip("/")
    below = path.startswith(prefix)
    if segment_aligned:
        below = (path == prefix) | path.startswith(prefix + "/")
    return (authority == start_authority) & below


def classify_link(scoped: Column, extension: Column) -> Column:
    """``save`` for PDF files anywhere, ``enqueue`` for pages in scope, else ``ignore``."""
    return (
        F.when(extension == PDF_EXTENSION, "save")
        .when(scoped & extension.isin(*HTML_EXTENSIONS), "enqueue")
        .otherwise("ignore")
    )


def content_type_status(content_type: Column | str) -> Column:
    """``keep`` for text, HTML and PDF, ``skip`` for other types, ``error`` without a type."""
    kind = F.lower(as_column(content_type))
    wanted = kind.contains("text") | kind.contains("html") | kind.contains("pdf")
    return F.when(F.coalesce(kind, F.lit("")) == "", "error").when(wanted, "keep").otherwise("skip")


def save_extension(content_type: Column | str, path: Column | str) -> Column:
    kind = F.lower(as_column(content_type))
    return (
        F.when(kind.contains("text/html"), ".html")
        .when(kind.contains("application/pdf"), ".pdf")
        .otherwise(path_extension(path))
    )


def percent_decode(text: Column | str) -> Column:
    """Decode %XX as UTF-8; a '+' and an incomplete escape stay as they are."""
    whole = F.regexp_replace(as_column(text), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(whole, F.lit("+"), F.lit("%2B")))


def path_segments(path: Column | str) -> Column:
    """Decoded segments of a path, outer slashes removed; the root gives one empty segment."""
    return F.transform(F.split(F.btrim(as_column(path), F.lit("/")), "/"), percent_decode)


def unsafe_segments(segments: Column | str) -> Column:
    """Would a decoded segment leave its folder?"""
    return F.exists(
        as_column(segments),
        lambda s: (s == "..") | s.contains("/") | s.contains("\\") | s.contains("\0"),
    )


def file_path(segments: Column | str, extension: Column | str) -> Column:
    """Relative file path; the extension is added unless the name ends in it."""
    segments, extension = as_column(segments), as_column(extension)
    folders = F.filter(F.slice(segments, 1, F.size(segments) - 1), lambda s: ~s.isin("", "."))
    last = F.element_at(segments, -1)
    name = F.when(last == "", "index").otherwise(last)
    named = F.when(name.endswith(extension), name).otherwise(F.concat(name, extension))
    return F.array_join(F.concat(folders, F.array(named)), "/")


def with_local_path(df: DataFrame, url: str = "url", content_type: str = "content_type") -> DataFrame:
    """Add ``local_path``, the file a URL is saved under, and ``unsafe`` for one not to use."""
    staged = with_url_parts(df, url, "_", ("path",))
    staged = let(
        staged,
        {
            "_segments": path_segments("_path"),
            "_extension": save_extension(content_type, "_path"),
        },
    )
    found = {
        "local_path": file_path("_segments", "_extension"),
        "unsafe": unsafe_segments("_segments"),
    }
    return let(staged, found).drop("_path", "_segments", "_extension")
