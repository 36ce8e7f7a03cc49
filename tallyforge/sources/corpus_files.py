"""A corpus of files as a table: names, types, sizes and extracted text.

Text formats decode in Spark. Office files are zip archives of XML, which a
pandas UDF reads with the standard library; PDF has no reader here and gives a
note, as do images and unknown types.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from functools import reduce
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.functions import labels, text
from tallyforge.sources.folders import read_each

#: Rows of a CSV file that its table shows.
TABLE_ROWS = 50_000
TEXT = (".txt", ".md", ".csv", ".tsv", ".html", ".htm", ".json", ".xml", ".yaml", ".yml", ".log")
IMAGES = (".jpg", ".jpeg", ".png", ".gif", ".webp", ".bmp", ".tiff")
OFFICE = (".docx", ".xlsx", ".pptx")
MAX_BYTES, MAX_ROWS = 5 * 1024 * 1024, 1000


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def texts(node, paragraph: str, run: str) -> list[str]:
    return ["".join(t.text or "" for t in p.iter() if local(t.tag) == run) for p in node.iter() if local(p.tag) == paragraph]


def docx_text(z: zipfile.ZipFile) -> str:
    return "\n\n".join(p for p in texts(ElementTree.fromstring(z.read("word/document.xml")), "p", "t") if p.strip())


def pptx_text(z: zipfile.ZipFile) -> str:
    slides = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
    found = [(i, [p for p in texts(ElementTree.fromstring(z.read(n)), "p", "t") if p.strip()]) for i, n in enumerate(slides, 1)]
    return "\n\n".join(f"--- Slide {i} ---\n" + "\n".join(ps) for i, ps in found if ps)


def xlsx_rows(z: zipfile.ZipFile):
    """Yields (sheet, rows of cells as text), cells in their columns."""
    shared = ["".join(t.text or "" for t in s.iter() if local(t.tag) == "t") for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
    names = [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if local(s.tag) == "sheet"]
    files = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
    for name, file in zip(names, files):
        rows = []
        for row in (r for r in ElementTree.fromstring(z.read(file)).iter() if local(r.tag) == "row"):
            cells: list[str] = []
            for c in (x for x in row if local(x.tag) == "c"):
                value = next((v.text or "" for v in c.iter() if local(v.tag) in ("v", "t")), "")
                letters = re.match(r"[A-Z]+", c.get("r") or "")
                if letters:
                    at = 0
                    for letter in letters[0]:
                        at = at * 26 + ord(letter) - 64
                    cells += [""] * (at - 1 - len(cells))
                cells.append(shared[int(value)] if c.get("t") == "s" and value else value)
            rows.append(cells)
        yield name, rows


def xlsx_text(z: zipfile.ZipFile, max_rows: int) -> str:
    out = []
    for name, rows in xlsx_rows(z):
        kept = ["\t".join(cells) for cells in rows[:max_rows] if any(cells)]
        out += [f"=== Sheet: {name} ===", *kept, f"[{len(kept)} rows]"]
    return "\n".join(out)


def xlsx_labelled(z: zipfile.ZipFile) -> str:
    """Sheets from their header on, which is the first row of two filled cells or more; the label says which row that is."""
    out = []
    for name, rows in xlsx_rows(z):
        header = next((i for i, cells in enumerate(rows) if sum(map(bool, cells)) >= 2), 0)
        kept = ["\t".join(c.strip() for c in cells) for cells in rows[header:] if any(cells)]
        if kept:
            out.append(f"=== Sheet: {name} ({len(kept)} rows, use header={header} when reading with pandas) ===\n" + "\n".join(kept))
    return "\n\n".join(out) or "[Empty workbook]"


def ruled_table(rows: list[list[str]], always: bool = False) -> str:
    """Rows of equal width as `| a | b |` lines, with a rule after the first one where there are others (or always)."""
    width = max(map(len, rows), default=0)
    lines = ["| " + " | ".join(cells + [""] * (width - len(cells))) + " |" for cells in rows]
    if lines and (always or len(lines) > 1):
        lines.insert(1, "| " + " | ".join(["---"] * width) + " |")
    return "\n".join(lines)


def table_cells(table, row: str, cell: str, paragraph: str, run: str) -> list[list[str]]:
    """Cells of a table of a document or slide; line breaks inside read as blanks."""
    inner = lambda node, name: [x for x in node.iter() if local(x.tag) == name]
    return [[" ".join(texts(c, paragraph, run)).strip() for c in inner(r, cell)] for r in inner(table, row)]


def docx_parts(z: zipfile.ZipFile) -> list:
    """Paragraphs, as text, and tables, as rows, in their order."""
    body = next((n for n in ElementTree.fromstring(z.read("word/document.xml")) if local(n.tag) == "body"), ())
    out: list = []
    for node in body:
        if local(node.tag) == "p":
            out += [t.strip() for t in texts(node, "p", "t") if t.strip()]
        elif local(node.tag) == "tbl":
            out.append(table_cells(node, "tr", "tc", "p", "t"))
    return out


def slides(z: zipfile.ZipFile) -> list[tuple[int, list, str]]:
    """(number, texts and tables in order, speaker notes) of each slide."""
    number = lambda n: int(re.findall(r"\d+", n)[-1])
    out = []
    for i, name in enumerate(sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=number), 1):
        parts: list = []
        for node in ElementTree.fromstring(z.read(name)).iter():
            if local(node.tag) == "txBody":
                parts += [t.strip() for t in texts(node, "p", "t") if t.strip()]
            elif local(node.tag) == "tbl":
                parts.append(table_cells(node, "tr", "tc", "p", "t"))
        inside = {t for p in parts if isinstance(p, list) for r in p for t in r}
        parts = [p for p in parts if isinstance(p, list) or p not in inside]
        notes = f"ppt/notesSlides/notesSlide{number(name)}.xml"
        out.append((i, parts, "\n".join(t for t in texts(ElementTree.fromstring(z.read(notes)), "p", "t")).strip() if notes in z.namelist() else ""))
    return out


def csv_rows(content: bytes, ext: str) -> tuple[list[list[str]], int]:
    """(rows of TABLE_ROWS at most, header included, all rows)."""
    rows, n = [], 0
    for row in csv.reader(io.StringIO(content.decode("utf-8", "replace"), newline=""), delimiter="\t" if ext == ".tsv" else ","):
        n += 1
        if n <= TABLE_ROWS + 1:
            rows.append([c.strip().replace("\n", " ").replace("|", "\\|") for c in row])
    return rows, n


def file_table(content: bytes, ext: str, name: str) -> str:
    """A file as text whose tables are ruled lines, between lines that name it; null bytes and broken files give a note."""
    try:
        if ext in (".csv", ".tsv"):
            rows, n = csv_rows(content, ext)
            if not rows:
                return f"\n[File: {name} — empty CSV/TSV]\n"
            kind, body = f"CSV ({n - 1} data rows)" if n <= TABLE_ROWS + 1 else f"CSV ({TABLE_ROWS:,}+ rows, showing subset)", ruled_table(rows, True)
        else:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                if ext == ".docx":
                    kind, body = "Word", "\n\n".join(p if isinstance(p, str) else ruled_table(p) for p in docx_parts(z) if p)
                elif ext == ".xlsx":
                    sheets = [(s, [[c.strip() for c in r] for r in rows if any(c.strip() for c in r)]) for s, rows in xlsx_rows(z)]
                    kind, body = "Excel", "\n\n".join(f"### Sheet: {s}\n{ruled_table(rows, True)}\n({len(rows) - 1} data rows)" for s, rows in sheets if rows)
                else:
                    found = slides(z)
                    kind = f"PowerPoint, {len(found)} slides"
                    listed = [(i, [p if isinstance(p, str) else ruled_table(p) for p in parts] + ([f"[Speaker notes: {note}]"] if note else [])) for i, parts, note in found]
                    body = "\n\n".join("\n".join([f"### Slide {i}", *lines]) for i, lines in listed if lines)
        return f"\n--- Document: {name} ({kind}) ---\n{body}\n--- End: {name} ---\n"
    except Exception as error:  # a broken file is a row with a note, not a failed job
        return f"\n[File: {name} — could not be read: {error}]\n"


def labelled_text(content: bytes, ext: str) -> str:
    """The plainer form: workbooks from their detected header on, tables of documents as tabbed lines, slides with a heading."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            if ext == ".xlsx":
                return xlsx_labelled(z)
            if ext == ".docx":
                parts = docx_parts(z)
                rows = ["\t".join(c for c in r if c) for p in parts if isinstance(p, list) for r in p]
                return "\n".join([p for p in parts if isinstance(p, str)] + [r for r in rows if r]) or "[Empty document]"
            found = [f"=== Slide {i} ===\n" + "\n".join(p for p in parts if isinstance(p, str)) for i, parts, _ in slides(z) if any(isinstance(p, str) for p in parts)]
            return "\n\n".join(found) or "[Empty presentation]"
    except Exception as error:
        return f"[{ext[1:].upper()} extraction error: {error}]"


def office_text(content: bytes, ext: str, max_rows: int) -> tuple[str, bool]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            found = docx_text(z) if ext == ".docx" else pptx_text(z) if ext == ".pptx" else xlsx_text(z, max_rows)
        return found, bool(found)
    except Exception as error:  # a broken file is a row with a note, not a failed job
        return f"[{ext[1:].upper()} extraction error: {error}]", False


def office_udf(max_rows: int):
    @F.pandas_udf("text string, extractable boolean")
    def read(content: pd.Series, ext: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([office_text(c, e, max_rows) for c, e in zip(content, ext)], columns=["text", "extractable"])

    return read


def table_udf():
    @F.pandas_udf("string")
    def read(content: pd.Series, ext: pd.Series, name: pd.Series) -> pd.Series:
        return pd.Series([file_table(c, e, n) for c, e, n in zip(content, ext, name)])

    return read


def labelled_udf():
    @F.pandas_udf("string")
    def read(content: pd.Series, ext: pd.Series) -> pd.Series:
        return pd.Series([labelled_text(c, e) for c, e in zip(content, ext)])

    return read


#: What text files are called in their content block.
FORMAT_NAMES = {".txt": "Text", ".md": "Markdown", ".html": "HTML", ".htm": "HTML", ".json": "JSON", ".xml": "XML"}


def content_blocks(files: DataFrame) -> DataFrame:
    """Rows of path and content as (filename, extension, type, media_type, body): tables and texts between lines that name them, images and PDF in base64."""
    rows = files.select("content", F.element_at(F.split("path", "/"), -1).alias("filename")).withColumn("extension", labels.extension("filename"))
    ext, name = F.col("extension"), F.col("filename")
    kind = F.when(ext.isin(*IMAGES), "image").when(ext == ".pdf", "document").otherwise("text")
    tabled = ext.isin(".csv", ".tsv", *OFFICE)
    table = rows.filter(tabled).withColumn("body", table_udf()("content", "extension", "filename"))
    title = F.coalesce(labels.literal_map(FORMAT_NAMES)[ext], F.lit("Text"))
    plain = F.concat(F.lit("\n--- Document: "), name, F.lit(" ("), title, F.lit(") ---\n"), F.col("content").cast("string"), F.lit("\n--- End: "), name, F.lit(" ---\n"))
    rest = rows.filter(~tabled).withColumn("body", F.when(kind == "text", plain).otherwise(F.base64("content")))
    return table.unionByName(rest).select("filename", "extension", kind.alias("type"), labels.mime_type("extension").alias("media_type"), "body")


def file_error(ext: Column, size: Column, supported: tuple[str, ...] = (*TEXT, *IMAGES, *OFFICE, ".pdf"), max_bytes: int = MAX_BYTES) -> Column:
    return F.when(size > max_bytes, F.concat(F.lit("File too large: "), size.cast("string"))).when(~ext.isin(*supported), F.concat(F.lit("Unsupported format: "), ext))


def corpus(files: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Documents from rows of path, length and content, one row each. An id is made of name and size; of files that share both, all but the last path have ids of their whole paths."""
    rows = files.select("path", F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("size_bytes"), "content")
    rows = rows.filter(~F.rlike("filename", F.lit(r"^[.~]"))).withColumn("extension", labels.extension("filename"))
    ext = F.col("extension")
    office = rows.filter(ext.isin(*OFFICE)).withColumn("r", office_udf(max_rows)("content", "extension")).select("*", "r.*").drop("r")
    note = (
        F.when(ext.isin(*IMAGES), F.concat(F.lit("[Image file: "), F.col("filename"), F.lit(", size="), F.format_number("size_bytes", 0), F.lit(" bytes, format="), ext, F.lit(". Image content not available via text extraction.]")))
        .when(ext == ".pdf", "[PDF extraction requires a PDF reader]")
        .otherwise(F.concat(F.lit("[Unsupported format: "), ext, F.lit("]")))
    )
    plain = ext.isin(*TEXT)
    rest = rows.filter(~ext.isin(*OFFICE)).withColumn("text", F.when(plain, F.col("content").cast("string")).otherwise(note)).withColumn("extractable", plain)
    found = office.unionByName(rest).drop("content").withColumnRenamed("text", "text_content")
    found = found.withColumn("doc_id", text.document_id("filename", "size_bytes")).withColumn("mime_type", labels.mime_type("extension"))
    found = found.withColumn("num_tokens_est", F.when(F.col("extractable"), text.estimated_tokens("text_content")).otherwise(0))
    last = found.groupBy("doc_id").agg(F.max("path").alias("__last"))
    own = F.when(F.col("path") == F.col("__last"), F.col("doc_id")).otherwise(text.document_id("path", "size_bytes"))
    return found.join(last, "doc_id").withColumn("doc_id", own).drop("__last")


def read_corpus(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files of a directory, without those in sub-directories, or of a list of paths, of which those that do not exist are warned of."""
    parts = read_each(path, lambda _, p: spark.read.format("binaryFile").load(p))
    return corpus(reduce(DataFrame.unionByName, parts or [spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")]))


def pipe_table(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A table's rows as `a | b` lines, with bars in values escaped."""
    safe = [F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in columns]
    return rows.select(F.concat_ws(" | ", *safe).alias("line"))
