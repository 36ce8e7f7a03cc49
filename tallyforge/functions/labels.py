"""Labels read off text: types, formats, links, failure categories, MIME types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.predicates import col, is_true

# Codes of research types with their names and evaluation types.
RESEARCH_TYPES = {
    "CRP": ("constrained research prompt", "IAT-2"),
    "RCP": ("relevance compression prompt", "IAT-1"),
    "SCP": ("structural compliance prompt", "IAT-3"),
    "LDP": ("latent decomposition prompt", "IAT-1"),
    "FSP": ("failure-sensitive prompt", "IAT-3"),
}
# Extensions and MIME types.
MIME_TYPES = {
    ".pdf": "application/pdf",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".csv": "text/csv",
    ".tsv": "text/tab-separated-values",
    ".txt": "text/plain",
    ".md": "text/markdown",
    ".html": "text/html",
    ".htm": "text/html",
    ".json": "application/json",
    ".xml": "application/xml",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
}
FORMAT_LIBRARIES = {"xlsx": "openpyxl", "docx": "python-docx (from docx import Document)", "pptx": "python-pptx (from pptx import Presentation)"}
# Patterns of prompts that ask for a file.
VERBS = r"\b(?:present|output|create|produce|generate|deliver|build)\b[^.!?\n]{0,120}"
FORMAT_PATTERNS = {"xlsx": rf"(?i){VERBS}\bexcel\b", "docx": r"(?i)\bword\s+doc(?:ument)?\b", "pptx": rf"(?i){VERBS}\bpowerpoint\b"}


def literal_map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def research_type(raw: Column | str) -> Column:
    """Canonical code of a type's code or name; '' if there is none."""
    known = {code.lower(): code for code in RESEARCH_TYPES} | {name: code for code, (name, _) in RESEARCH_TYPES.items()} | {"failure sensitive prompt": "FSP"}
    return F.coalesce(literal_map(known)[F.lower(F.trim(col(raw)))], F.lit(""))


def iat_type(code: Column | str) -> Column:
    return F.coalesce(literal_map({c: iat for c, (_, iat) in RESEARCH_TYPES.items()})[col(code)], F.lit(""))


def output_formats(prompt: Column | str) -> Column:
    """Sorted formats of the files that a prompt asks for."""
    return F.array_compact(F.array(*[F.when(F.rlike(col(prompt), F.lit(p)), name) for name, p in sorted(FORMAT_PATTERNS.items())]))


def extension(name: Column | str) -> Column:
    return F.lower(F.regexp_extract(col(name), r"(\.[^./]+)$", 1))


def mime_type(ext: Column | str) -> Column:
    return F.coalesce(literal_map(MIME_TYPES)[col(ext)], F.lit("application/octet-stream"))


def format_library(name: Column | str) -> Column:
    return literal_map(FORMAT_LIBRARIES)[col(name)]


def link(ref: Column | str) -> Column:
    """(type, id, doc_type) of a shared-drive link; nulls for local paths and other links."""
    r = F.trim(col(ref))
    ident = "([a-zA-Z0-9_-]+)"
    docs, open_, query = rf"docs\.google\.com/(document|spreadsheets|presentation)/d/{ident}", rf"drive\.google\.com/(?:open|uc)\?(?:.*&)?id={ident}", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*google\.com[^?#]*\?(?:[^#]*&)?id=([^&#]+)"
    none = F.lit(None).cast("string")

    def found(kind: str, pattern: str, group: int = 1, doc_type: Column = none) -> tuple[Column, Column]:
        return F.rlike(r, F.lit(pattern)), F.struct(F.lit(kind).alias("type"), F.regexp_extract(r, pattern, group).alias("id"), doc_type.alias("doc_type"))

    rules = [
        found("file", rf"^gdrive://{ident}$"),
        found("workspace_doc", docs, 2, F.regexp_extract(r, docs, 1)),
        found("file", rf"drive\.google\.com/file/d/{ident}"),
        found("file", open_),
        found("folder", rf"drive\.google\.com/drive(?:/u/\d+)?/folders/{ident}"),
        found("file", query),
    ]
    local = r.startswith("/") | r.startswith("./")
    out = F.when(local, F.lit(None).cast("struct<type:string,id:string,doc_type:string>"))
    for test, value in rules:
        out = out.when(test, value)
    return out


def export_failure(completed="completed", forced_stop="forced_stop", error="error") -> Column:
    """Failure category of an exported row; '' for completed passes, whatever stopped them."""
    text = F.trim(F.coalesce(col(error), F.lit("")))
    low, forced = F.lower(text), is_true(forced_stop)
    has = lambda *words: F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w))
    formats = F.regexp_extract(text, r"(?i)file generation failed for:\s*(\[.*?\])", 1)
    return (
        F.when(is_true(completed), "")
        .when((text == "") & ~forced, "Failed — no error message")
        .when(has("stuck", "in_progress", "aborting"), "Timeout — interaction stuck")
        .when(has("file generation failed"), F.trim(F.concat(F.lit("File generation failed "), formats)))
        .when(has("preflight", "max_inline_chars", "3m char"), "Pre-flight failed — corpus too large")
        .when(has("budget", "max_cost"), "Forced stop — cost budget exceeded")
        .when(has("max_iterations") | (has("iteration") & forced), "Forced stop — iteration limit")
        .when(forced & (text != ""), F.concat(F.lit("Forced stop — "), F.substring(text, 1, 80)))
        .when(forced, "Forced stop")
        .otherwise(F.substring(text, 1, 120))
    )


def diagnosed_failure(error: Column | str) -> Column:
    """Failure category of the triage report."""
    low = F.lower(F.coalesce(col(error), F.lit("")))
    has = low.contains
    library = F.coalesce(*[F.when(has(name), f" ({name})") for name in ("sklearn", "statsmodels", "pulp", "scipy", "xlsxwriter")], F.lit(""))  # fixed values: the first that is named
    detail = (
        F.when(has("no such file") | has("filenotfounderror"), " — file not found")
        .when(has("keyerror"), " — wrong column name")
        .when(has("assertionerror"), " — wrong header arg")
        .when(has("attributeerror"), " — wrong API usage")
        .when(has("modulenotfounderror") | has("no module"), F.concat(F.lit(" — missing library"), library))
        .otherwise("")
    )
    return (
        F.when(has("stuck in 'in_progress'") | has("staleinteractionerror"), "Gemini API timeout (in_progress)")
        .when(has("0 input_tokens") | has("0 tokens"), "Gemini API timeout (0 tokens)")
        .when(has("invalid_prompt") | (has("400") & has("invalid")), "Content policy 400")
        .when(has("there was a problem") & has("400"), "Content policy 400 (Gemini)")
        .when(has("file_output_not_produced") | has("did not generate the required file"), "File output not produced (model skipped)")
        .when(has("file generation failed"), F.concat(F.lit("File generation failed"), detail))
        .when(has("timeout"), "Timeout")
        .when(has("error"), "Other error")
        .otherwise("Unknown failure")
    )


def file_error_note(file_errors: Column | str) -> Column:
    """What failed, for passes that finished without some of their files."""
    parts = F.transform(F.map_entries(col(file_errors)), lambda e: F.concat(e["key"], F.lit(": "), diagnosed_failure(e["value"])))
    return F.when(F.size(parts) > 0, F.concat(F.lit("File generation failed: "), F.array_join(parts, "; "))).otherwise("")
