"""Text functions: identifiers, slugs, truncation, values as report text, code blocks, citations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.predicates import col

# The sentinels around a block.
BLOCK_START, BLOCK_END = "# GEMINI_FILE_OUTPUT_START", "# GEMINI_FILE_OUTPUT_END"
FENCED = r"(?is)`{3,}[ \t]*(?:python|py)?[ \t]*\n(.*?)\n?`{3,}"
LIBRARY_HINTS = {"xlsx": ("openpyxl", "pandas", "xlsxwriter"), "docx": ("docx", "Document"), "pptx": ("pptx", "Presentation"), "pdf": ("reportlab", "FPDF")}
CITATION = "array<struct<title:string,url:string,snippet:string>>"


# identifiers -----------------------------------------------------------------


def normal_id(raw: Column | str) -> Column:
    """Undo what spreadsheets do to ids: 123.0B reads 123B."""
    return F.regexp_replace(col(raw), r"^(\d+)\.0([A-Za-z]*)$", "$1$2")


def generated_id(name: Column | str, *content: Column | str) -> Column:
    """An id for a row without one, from its author and content, the same on every run."""
    slug = F.substring(F.regexp_replace(F.lower(F.trim(col(name))), r"[^a-z0-9]+", "_"), 1, 15)
    return F.concat(F.when(slug == "", "anon").otherwise(slug), F.lit("_"), F.substring(F.sha2(F.concat_ws("\u0001", *map(col, content)), 256), 1, 6))


def id_prefix(task_id: Column | str) -> Column:
    """An id without its suffix of an underscore and six hex digits."""
    return F.regexp_replace(col(task_id), r"^(.+)_[a-f0-9]{6}$", "$1")


def document_id(name: Column | str, size: Column | str) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", col(name), col(size).cast("string")), 256), 1, 12)


def slug(text: Column | str) -> Column:
    return F.regexp_replace(col(text), r"[^a-zA-Z0-9_\-.]", "_")


def safe_filename(text: Column | str) -> Column:
    return F.regexp_replace(col(text), r"(?U)[^\w\-.]", "_")


def solution_steps(logic: Column | str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(col(logic), F.lit("")), "\n"), lambda s: F.trim(s)), lambda s: F.length(s) > 10)


# truncation ------------------------------------------------------------------


def estimated_tokens(text: Column | str) -> Column:
    return F.floor(F.length(col(text)) / 4).cast("long")


def cut_prefix(text: Column | str, limit: int, marker: str) -> Column:
    return F.when(F.length(col(text)) > limit, F.concat(F.substring(col(text), 1, limit), F.lit(marker))).otherwise(col(text))


def head_and_tail(text: Column | str, name: Column | str, limit: Column) -> Column:
    """`text` within about `limit` characters: 70 % of them from its start, the rest from its end."""
    t, size = col(text), F.length(col(text))
    head, tail = F.floor(limit * 0.7).cast("int"), (F.floor(limit * 0.3) - 200).cast("int")
    k = lambda n: F.floor(n / 1000).cast("string")
    marker = F.concat(F.lit("\n\n[... TRUNCATED: "), col(name), F.lit(" — showing first ~"), k(head), F.lit("K and last ~"), k(tail), F.lit("K characters of "), k(size), F.lit("K total. "), k(size - head - tail), F.lit("K characters omitted. ...]\n\n"))
    return F.when(size <= limit, t).otherwise(F.concat(F.substring(t, F.lit(1), head), marker, F.substring(t, size - tail + 1, tail)))


def first_items(items: Column | str, n: int = 10) -> Column:
    """The first of a task's files, as many as are processed."""
    return F.slice(col(items), 1, n)


def strip(text: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col(text), r"^\s+|\s+$", "")


# report values ---------------------------------------------------------------


def timestamp(text: Column | str) -> Column:
    return F.try_to_timestamp(col(text))


def timestamp_text(text: Column | str) -> Column:
    return F.when(F.coalesce(col(text), F.lit("")) == "", "(none)").otherwise(F.coalesce(F.concat(F.date_format(timestamp(text), "yyyy-MM-dd  HH:mm:ss"), F.lit(" UTC")), col(text)))


def timestamp_slug(text: Column | str) -> Column:
    digits = F.substring(F.regexp_replace(col(text), "[^0-9]", ""), 1, 14)
    return F.when(F.coalesce(col(text), F.lit("")) == "", "unknown_time").otherwise(F.coalesce(F.date_format(timestamp(text), "yyyyMMdd_HHmmss"), F.when(digits != "", digits), F.lit("unknown_time")))


def duration_text(seconds: Column | str) -> Column:
    s = col(seconds)
    whole = F.floor(s)
    h, m, r = (F.floor(whole / 3600)).cast("string"), (F.floor(whole / 60) % 60).cast("string"), (whole % 60).cast("string")
    exact = F.concat(F.format_number(s, 2), F.lit(" s"))
    return (
        F.when(s.isNull(), "(none)")
        .when(whole >= 3600, F.concat(h, F.lit("h "), m, F.lit("m "), r, F.lit("s  ("), exact, F.lit(")")))
        .when(whole >= 60, F.concat(m, F.lit("m "), r, F.lit("s  ("), exact, F.lit(")")))
        .otherwise(exact)
    )


def number_text(value: Column | str) -> Column:
    return F.coalesce(F.format_number(col(value), 0), F.lit("(none)"))


def plain_text(value: Column | str) -> Column:
    return F.when(F.coalesce(col(value).cast("string"), F.lit("")) == "", "(none)").otherwise(col(value).cast("string"))


def money_text(value: Column | str) -> Column:
    return F.coalesce(F.format_number(col(value), 6), F.lit("(none)"))


def list_text(values: Column | str) -> Column:
    return F.when(F.coalesce(F.size(col(values)), F.lit(0)) <= 0, "(none)").otherwise(F.array_join(col(values), ", "))


def value_text(value: Column | str, kind: str) -> Column:
    """A value of the SQL type `kind` as report text: nothing is (none), lists are joined, fractions have six digits."""
    v = col(value)
    if kind.startswith("array"):
        return F.when(F.coalesce(F.size(v), F.lit(0)) <= 0, "(none)").otherwise(F.array_join(v.cast("array<string>"), ", "))
    if kind in ("double", "float") or kind.startswith("decimal"):
        return F.coalesce(F.format_number(v, 6), F.lit("(none)"))
    return F.when(F.coalesce(v.cast("string"), F.lit("")) == "", "(none)").otherwise(v.cast("string"))


def field(label: str, value: Column, width: int = 22) -> Column:
    """A report line; further lines of the value stand below its first character."""
    return F.concat(F.lit(f"{label:<{width}}: "), F.replace(F.rtrim(value), F.lit("\n"), F.lit("\n" + " " * (width + 2))), F.lit("\n"))


# code blocks -----------------------------------------------------------------


def fenced_blocks(text: Column | str) -> Column:
    return F.regexp_extract_all(col(text), F.lit(FENCED), F.lit(1))


def marked_block(text: Column | str, marker: str) -> Column:
    """The block between the sentinels, else the first fenced block with `marker`; null if there is none."""
    t = col(text)
    start, end = F.locate(BLOCK_START, t), F.locate(BLOCK_END, t)
    between = F.substring(t, start, end - start + len(BLOCK_END))
    lines = F.filter(F.split(between, "\n"), lambda x: ~F.rlike(F.trim(x), F.lit("^`{3,}")))
    fenced = F.get(F.filter(fenced_blocks(t), lambda b: b.contains(marker)), F.lit(0))
    return F.when((start > 0) & (end > start), F.trim(F.array_join(lines, "\n"))).otherwise(F.regexp_replace(fenced, r"^\s+|\s+$", ""))


def last_library_block(text: Column | str, fmt: str) -> Column:
    """The last fenced block that names a library for files of this format."""
    hints = F.array(*map(F.lit, LIBRARY_HINTS.get(fmt, ())))
    blocks = F.filter(fenced_blocks(text), lambda b: F.exists(hints, lambda h: b.contains(h)))
    return F.when(F.size(blocks) > 0, F.regexp_replace(F.element_at(blocks, -1), r"^\s+|\s+$", ""))


def without_block(text: Column | str) -> Column:
    """A report without its sentinel block and the fence lines around it."""
    t = col(text)
    start, end = F.locate(BLOCK_START, t), F.locate(BLOCK_END, t)
    before = F.regexp_replace(F.substring(t, F.lit(1), start - 1), r"(?:(?:^|\n)[ \t]*`{3,}[^\n]*|\s)+$", "")
    after = F.regexp_replace(F.substring(t, end + len(BLOCK_END), F.length(t)), r"^\n*(?:`{3,}\s*(?:\n|$))?\n*", "")
    joined = F.when(after == "", before).otherwise(F.concat(before, F.lit("\n\n"), after))
    return F.regexp_replace(F.when((start > 0) & (end >= start), joined).otherwise(t), r"^\s+|\s+$", "")


def clean_code(code: Column | str) -> Column:
    """Code without citation markers, with two known mistakes of table access mended. It is never run."""
    c = F.regexp_replace(col(code), r"""(['"][^'"]*['"]) *\[cite:\s*[\d,\s]+\](\s*:)""", "$1$2")
    c = F.regexp_replace(c, r"(:\s*)\[cite:\s*[\d,\s]+\]", "$1[]")
    c = F.regexp_replace(c, r"\[cite:\s*[\d,\s]+\]", "")
    c = F.replace(c, F.lit(".rows.cells"), F.lit(".rows[0].cells"))
    return F.regexp_replace(c, r"(\b\w+_cells)\.text\b", "$1[0].text")


# citations -------------------------------------------------------------------
# The patterns of references, links and bare urls in the functions below.


def matches(text: Column, pattern: str, url_group: int, title_group: int | None, strip: bool) -> Column:
    urls = F.regexp_extract_all(text, F.lit(pattern), F.lit(url_group))
    titles = F.regexp_extract_all(text, F.lit(pattern), F.lit(title_group)) if title_group else F.transform(urls, lambda u: F.lit(""))
    clean = lambda u: F.regexp_replace(u, r"[.,)]+$", "") if strip else u
    return F.zip_with(titles, urls, lambda t, u: F.struct(F.trim(t).alias("title"), clean(u).alias("url"), F.lit("").alias("snippet"))).cast(CITATION)


def first_by_url(citations: Column) -> Column:
    """Citations in order, without those whose url came before."""
    return F.aggregate(citations, F.array().cast(CITATION), lambda acc, c: F.when(F.exists(acc, lambda a: a["url"] == c["url"]), acc).otherwise(F.concat(acc, F.array(c))))


def report_citations(text: Column | str) -> Column:
    """Reference lists and markdown links of a report; bare urls only if there are neither."""
    t = F.coalesce(col(text), F.lit(""))
    named = F.concat(matches(t, r"\[(\d+)\]\s+(.+?)\s+[—–-]+\s+(https?://\S+)", 3, 2, True), matches(t, r"\[([^\]]+)\]\((https?://[^\)]+)\)", 2, 1, False))
    return first_by_url(F.when(F.size(named) > 0, named).otherwise(matches(t, r"https?://\S{10,}", 0, None, True)))


def numbered_citations(text: Column | str) -> Column:
    """`[n] title — url` lines as (index, title, url)."""
    pattern = F.lit(r"\[(\d+)\]\s*([^\n]+?)\s*[—–-]+\s*(https?://\S+)")
    parts = [F.regexp_extract_all(col(text), pattern, F.lit(g)) for g in (1, 2, 3)]
    return F.transform(F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("n", "title", "url"))]), lambda z: F.struct(z["n"].cast("int").alias("index"), z["title"].alias("title"), z["url"].alias("url")))


def citations_text(citations: Column | str) -> Column:
    """`title=…, url=…, snippet=…` parts joined by ` | `; blank fields are left out."""
    some = lambda v: F.when(F.coalesce(v, F.lit("")) != "", v)
    one = lambda c: F.concat_ws(", ", F.concat(F.lit("title="), some(c["title"])), F.concat(F.lit("url="), some(c["url"])), F.concat(F.lit("snippet="), F.trim(F.regexp_replace(some(c["snippet"]), r"\s+", " "))))
    return F.array_join(F.filter(F.transform(F.coalesce(col(citations), F.array().cast(CITATION)), one), lambda s: s != ""), " | ")


def normal_citations(items: Column | str) -> Column:
    """Citations given as url strings or JSON objects, snippets of at most 200 characters."""
    get = lambda x, key: F.coalesce(F.get_json_object(x, f"$.{key}"), F.lit(""))
    return F.transform(col(items), lambda x: F.when(F.trim(x).startswith("{"), F.struct(get(x, "title").alias("title"), get(x, "url").alias("url"), F.substring(get(x, "snippet"), 1, 200).alias("snippet"))).otherwise(F.struct(F.lit("").alias("title"), x.alias("url"), F.lit("").alias("snippet")))).cast(CITATION)


def external_citations(citations: Column | str, file_names: Column | str) -> Column:
    """Citations that name none of the provided files in title or url."""
    named = lambda c: F.exists(col(file_names), lambda f: F.lower(c["title"]).contains(F.lower(f)) | F.lower(c["url"]).contains(F.lower(f)))
    return F.filter(col(citations), lambda c: ~F.coalesce(named(c), F.lit(False)))


def compliance(total: Column, external: Column) -> Column:
    return F.when(total == 0, 1.0).otherwise((total - external) / total)


def output_files_text(files: Column | str, fallback: Column | str) -> Column:
    """Paths of output files, given as strings or JSON objects, joined by `; `."""
    get = lambda x, key: F.when(F.coalesce(F.get_json_object(x, f"$.{key}"), F.lit("")) != "", F.get_json_object(x, f"$.{key}"))
    one = lambda x: F.trim(F.when(x.startswith("{"), F.coalesce(get(x, "path"), get(x, "filename"), get(x, "name"), x)).otherwise(x))
    return F.when(F.coalesce(F.size(col(files)), F.lit(0)) <= 0, F.trim(F.coalesce(col(fallback), F.lit("")))).otherwise(F.array_join(F.filter(F.transform(col(files), one), lambda s: s != ""), "; "))
