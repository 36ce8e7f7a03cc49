"""Queries on documents as a corpus, pages and texts of reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import labels, text
from tallyforge.operators import corpus
from tallyforge.plans.registry import query
from tallyforge.plans.views import FILES_SQL, files, quoted, table

TERMS = ("the", "tion", "the")


def times(t: str) -> str:
    return f"(length(low) - length(replace(low, '{t}', ''))) // {len(t)}"


@query(f"""WITH {FILES_SQL}, l AS (SELECT filename, lower(text_content) AS low FROM files WHERE extractable),
s AS (SELECT filename, ({" + ".join(f"CAST({times(t)} > 0 AS INTEGER)" for t in TERMS)}) / {len(TERMS)} * (1 + ln(1 + {" + ".join(times(t) for t in TERMS)})) AS score FROM l)
SELECT filename, round(score, 3) AS relevance_score FROM s WHERE score > 0 ORDER BY score DESC, filename LIMIT 5""")
def f26_o04_search(spark, sf):
    return corpus.search(files(spark, sf).filter("extractable"), "The tion of the").select("filename", "relevance_score")


@query(f"""WITH {FILES_SQL}, l AS (SELECT *, strpos(lower(text_content), 'ing') AS pos FROM files WHERE extractable), k AS (SELECT *, (length(lower(text_content)) - length(replace(lower(text_content), 'ing', ''))) // 3 AS c FROM l WHERE pos > 0)
SELECT filename, substr(trim(substr(text_content, CAST(greatest(pos - 101, 0) + 1 AS BIGINT), CAST(pos - 1 + 3 + 100 - greatest(pos - 101, 0) AS BIGINT)), ' '), 1, 300) AS snippet FROM k ORDER BY 1 + ln(1 + c) DESC, filename LIMIT 20""")
def f27_snippets(spark, sf):
    return corpus.search(files(spark, sf).filter("extractable"), "ing", 20).select("filename", "snippet")


@query(rf"""WITH {FILES_SQL}, q AS (SELECT item_id AS query_id, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}_]+'), lambda t: length(t) > 2) AS terms FROM benchmark),
l AS (SELECT filename, text_content, lower(text_content) AS low FROM files WHERE extractable), e AS (SELECT query_id, len(terms) AS size, unnest(terms) AS term FROM q), d AS (SELECT DISTINCT term FROM e),
c AS (SELECT term, filename, CAST((length(low) - length(replace(low, term, ''))) // length(term) AS BIGINT) AS hits FROM d, l WHERE contains(low, term)),
s AS (SELECT query_id, filename, count(*) / any_value(size) * (1 + ln(1 + sum(hits))) AS score, CAST(sum(hits) AS BIGINT) AS match_count FROM e JOIN c USING (term) GROUP BY ALL),
b AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, filename) AS INTEGER) AS rank FROM s QUALIFY rank <= 5),
f AS (SELECT b.*, text_content, low, list_filter(terms, lambda t: contains(low, t))[1] AS first FROM b JOIN l USING (filename) JOIN q USING (query_id)), p AS (SELECT *, strpos(low, first) AS pos FROM f)
SELECT query_id, rank, filename, round(score, 3) AS relevance_score, match_count, substr(trim(substr(text_content, CAST(greatest(pos - 101, 0) + 1 AS BIGINT), CAST(pos - 1 + length(first) + 100 - greatest(pos - 101, 0) AS BIGINT)), ' '), 1, 300) AS snippet FROM p""")
def j11_f26_o04_search_many(spark, sf):
    """Every benchmark item as a query over the whole corpus."""
    queries = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return corpus.search_many(files(spark, sf).filter("extractable"), queries)


@query(f"WITH {FILES_SQL} SELECT CAST(doc_id AS VARCHAR) AS doc_id, filename, extension, mime_type, size_bytes, num_tokens_est, extractable FROM files")
def p07_o07_list_documents(spark, sf):
    return corpus.list_documents(files(spark, sf).withColumn("doc_id", F.col("doc_id").cast("string")))


@query(f"WITH {FILES_SQL} SELECT filename, substr(text_content, 1, 100) AS text_content, length(text_content) AS total_chars, length(text_content) > 100 AS truncated FROM files WHERE filename = 'doc_7.txt'")
def f28_j14_fetch(spark, sf):
    return corpus.fetch(files(spark, sf), "DOC_7.TXT", 100).select("filename", "text_content", F.col("total_chars").cast("long").alias("total_chars"), "truncated")


@query(f"WITH {FILES_SQL} SELECT count(*) AS documents, count(*) FILTER (extractable) AS extractable, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(sum(num_tokens_est) FILTER (extractable) AS BIGINT) AS tokens FROM files")
def a17_corpus_stats(spark, sf):
    return corpus.corpus_stats(files(spark, sf))


@query(f"WITH {FILES_SQL} SELECT filename, substr(sha256(filename || ':' || size_bytes), 1, 12) AS doc_id, num_tokens_est FROM files")
def f11_f13_document_ids(spark, sf):
    return files(spark, sf).select("filename", text.document_id("filename", "size_bytes").alias("doc_id"), text.estimated_tokens("text_content").alias("num_tokens_est"))


@query("""WITH f AS (SELECT doc_id, 'd' || doc_id || ['.pdf', '.CSV', '.weird', ''][doc_id % 4 + 1] AS name, length(text) * 400 AS size FROM documents)
SELECT doc_id, lower(regexp_extract(name, '(\\.[^./]+)$', 1)) AS ext, CASE doc_id % 4 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'text/csv' ELSE 'application/octet-stream' END AS mime,
CASE WHEN size > 5242880 THEN 'File too large: ' || size WHEN doc_id % 4 > 1 THEN 'Unsupported format: ' || lower(regexp_extract(name, '(\\.[^./]+)$', 1)) ELSE '' END AS error FROM f""")
def s16_f08_f12_routing(spark, sf):
    from tallyforge.sources.corpus_files import file_error

    kind = F.element_at(F.array(*map(F.lit, (".pdf", ".CSV", ".weird", ""))), (F.col("doc_id") % 4 + 1).cast("int"))
    d = table(spark, sf, "documents").withColumn("ext", labels.extension(F.concat(F.lit("d"), F.col("doc_id").cast("string"), kind)))
    return d.select("doc_id", "ext", labels.mime_type("ext").alias("mime"), F.coalesce(file_error(F.col("ext"), F.length("text").cast("long") * 400), F.lit("")).alias("error"))


# sections, budgets, truncation -----------------------------------------------


@query(r"""WITH p AS (SELECT conv_id, turn, CASE WHEN regexp_matches(lower(text[1:500]), 'tention|éré') THEN 'KEEP' WHEN regexp_matches(lower(text[1:500]), 'shth|ung') THEN 'DROP' ELSE 'NEUTRAL' END AS class FROM conversations),
l AS (SELECT *, last_value(CASE WHEN class <> 'NEUTRAL' THEN class END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS last FROM p)
SELECT conv_id, turn, class FROM l WHERE coalesce(last <> 'DROP', true)""")
def n05_f42_sections(spark, sf):
    d = table(spark, sf, "conversations").select("conv_id", "turn", corpus.page_class("text", ("shth", "ung"), ("tention", "éré")).alias("class"))
    return corpus.drop_sections(d, "conv_id", "turn")


MARKS = (*corpus.KEEP_WORDS, *corpus.DROP_WORDS)
ANY_SQL = lambda words: " OR ".join(f"contains(start, {quoted(w)})" for w in words)


@query(f"""WITH t AS (SELECT coalesce(source, '') AS document, doc_id AS page, CASE WHEN doc_id % 3 = 0 THEN [{", ".join(map(quoted, MARKS))}][doc_id // 3 % {len(MARKS)} + 1] || ' ' || coalesce(text, '') ELSE coalesce(text, '') END AS text FROM documents),
p AS (SELECT document, page, length(text) AS n, lower(text[1:500]) AS start FROM t), c AS (SELECT document, page, n, CASE WHEN {ANY_SQL(corpus.KEEP_WORDS)} THEN 'KEEP' WHEN {ANY_SQL(corpus.DROP_WORDS)} THEN 'DROP' ELSE 'NEUTRAL' END AS class FROM p),
w AS (SELECT *, row_number() OVER (PARTITION BY document ORDER BY page) AS place, count(*) OVER (PARTITION BY document) AS pages, last_value(CASE WHEN class <> 'NEUTRAL' THEN class END IGNORE NULLS) OVER (PARTITION BY document ORDER BY page ROWS UNBOUNDED PRECEDING) AS last FROM c),
l AS (SELECT *, sum(CASE WHEN place <= 10 THEN n END) OVER (PARTITION BY document) * (pages / least(pages, 10)) > 400000 AS large FROM w)
SELECT document, page, class FROM l WHERE NOT large OR coalesce(last <> 'DROP', true)""")
def f42_large_documents(spark, sf):
    """Sources as documents and texts as their pages, a third of which begin with a word of the fixed lists; only large documents lose sections."""
    d = table(spark, sf, "documents")
    mark = F.element_at(F.array(*map(F.lit, MARKS)), (F.floor(F.col("doc_id") / 3) % len(MARKS) + 1).cast("int"))
    body = F.coalesce(F.col("text"), F.lit(""))
    pages = d.select(F.coalesce("source", F.lit("")).alias("document"), F.col("doc_id").alias("page"), F.when(F.col("doc_id") % 3 == 0, F.concat(mark, F.lit(" "), body)).otherwise(body).alias("text"))
    return corpus.sections(pages, "document", "page", "text")


@query("""WITH RECURSIVE f AS (SELECT conv_id, turn AS ord, length(text) * 40 AS size, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM conversations),
r AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS used, CAST(NULL AS BIGINT) AS ord, CAST(NULL AS BIGINT) AS size, CAST(NULL AS BIGINT) AS lim, CAST(NULL AS BIGINT) AS kept FROM (SELECT DISTINCT conv_id FROM f)
  UNION ALL SELECT s.conv_id, s.i, s.used + s.kept, s.ord, s.size, s.lim, s.kept FROM (
    SELECT x.*, CASE WHEN x.size <= lim THEN x.size ELSE CAST(floor(lim * 0.7::DOUBLE) + floor(lim * 0.3::DOUBLE) - 200 + 150 AS BIGINT) END AS kept FROM (
      SELECT r.used, f.conv_id, f.i, f.ord, f.size, least(2000, greatest(6000 - r.used // 4, 1000)) * 4 AS lim FROM r JOIN f ON f.conv_id = r.conv_id AND f.i = r.i + 1) x) s)
SELECT conv_id, ord, size, lim AS "limit", kept FROM r WHERE i > 0""")
def n06_budgets(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", (F.length("text") * 40).alias("size"))
    return corpus.character_budgets(turns, "conv_id", "turn", "size", 2000, 6000)


@query("""SELECT doc_id, CASE WHEN length(text) <= 1000 THEN text ELSE substr(text, 1, 700) || chr(10) || chr(10) || '[... TRUNCATED: d — showing first ~0K and last ~0K characters of ' || (length(text) // 1000) || 'K total. ' || ((length(text) - 800) // 1000) || 'K characters omitted. ...]' || chr(10) || chr(10) || right(text, 100) END AS cut FROM documents""")
def f24_head_and_tail(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.head_and_tail("text", F.lit("d"), F.lit(1000)).alias("cut"))


@query("SELECT doc_id, CASE WHEN length(text) > 500 THEN substr(text, 1, 500) || ' [cut]' ELSE text END AS cut FROM documents")
def f25_p08_prefix(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.cut_prefix("text", 500, " [cut]").alias("cut"))


# citations, code -------------------------------------------------------------

REPORT_SQL = r"""r AS (SELECT conv_id, turn, text || chr(10) || CASE conv_id % 4 WHEN 0 THEN '[1] First work — https://a.example/' || conv_id || ').' || chr(10) || '[2] Again — https://a.example/' || conv_id || chr(10) || 'and [a link](https://b.example/x' || turn || ')'
  WHEN 1 THEN 'see https://c.example/' || conv_id || '/page, and https://c.example/' || conv_id || '/page' WHEN 2 THEN '```python' || chr(10) || 'import openpyxl' || chr(10) || 'x = ' || turn || chr(10) || '```' || chr(10) || '```' || chr(10) || 'print()' || chr(10) || '```' ELSE '' END AS report FROM conversations)"""


def reports(spark, sf):
    c, t = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    tail = (
        F.when(F.col("conv_id") % 4 == 0, F.concat(F.lit("[1] First work — https://a.example/"), c, F.lit(").\n[2] Again — https://a.example/"), c, F.lit("\nand [a link](https://b.example/x"), t, F.lit(")")))
        .when(F.col("conv_id") % 4 == 1, F.concat(F.lit("see https://c.example/"), c, F.lit("/page, and https://c.example/"), c, F.lit("/page")))
        .when(F.col("conv_id") % 4 == 2, F.concat(F.lit("```python\nimport openpyxl\nx = "), t, F.lit("\n```\n```\nprint()\n```")))
        .otherwise("")
    )
    return table(spark, sf, "conversations").select("conv_id", "turn", F.concat("text", F.lit("\n"), tail).alias("report"))


@query(rf"""WITH {REPORT_SQL} SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 'title=First work, url=https://a.example/' || conv_id || ' | title=a link, url=https://b.example/x' || turn
WHEN 1 THEN 'url=https://c.example/' || conv_id || '/page' ELSE '' END AS citations FROM r""")
def f18_f20_n08_citations(spark, sf):
    return reports(spark, sf).select("conv_id", "turn", text.citations_text(text.report_citations("report")).alias("citations"))


@query(rf"WITH {REPORT_SQL} SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 THEN '1=First work;2=Again' ELSE '' END AS found FROM r")
def f19_numbered_citations(spark, sf):
    found = F.transform(text.numbered_citations("report"), lambda c: F.concat_ws("=", c["index"].cast("string"), c["title"]))
    return reports(spark, sf).select("conv_id", "turn", F.array_join(found, ";").alias("found"))


@query(rf"""WITH {REPORT_SQL}, n AS (SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS total, CASE conv_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 1 ELSE 0 END AS external FROM r)
SELECT conv_id, turn, total, external, CASE WHEN total = 0 THEN 1.0::DOUBLE ELSE (total - external) / total END AS ratio FROM n""")
def f22_a21_j09_compliance(spark, sf):
    r = reports(spark, sf).withColumn("c", text.report_citations("report"))
    r = r.withColumn("total", F.size("c")).withColumn("external", F.size(text.external_citations("c", F.array(F.lit("A LINK"), F.lit("none.pdf")))))
    return r.select("conv_id", "turn", "total", "external", text.compliance(F.col("total"), F.col("external")).alias("ratio"))


@query("""WITH n AS (SELECT doc_id % 50 AS task_id, lower('DOC_' || doc_id || '.TXT') AS name FROM documents UNION SELECT doc_id % 50, lower(lang) FROM documents WHERE doc_id % 7 = 0 AND lang IS NOT NULL),
c AS (SELECT conv_id % 50 AS task_id, conv_id * 1000 + turn AS citation, text AS title, CASE WHEN turn % 5 < 4 THEN 'https://x.example/Doc_' || (conv_id % 50 + 50 * turn) || '.txt?v=' || conv_id END AS url FROM conversations),
x AS (SELECT *, coalesce(url, '') <> '' AND NOT EXISTS (SELECT 1 FROM n WHERE n.task_id = c.task_id AND (contains(lower(coalesce(c.title, '')), name) OR contains(lower(coalesce(c.url, '')), name))) AS external FROM c)
SELECT task_id, count(*) AS total, count(*) FILTER (external) AS external, (count(*) - count(*) FILTER (external)) / count(*) AS ratio, count(*) FILTER (external) = 0 AS compliant, coalesce(string_agg(url, ' ' ORDER BY citation, url) FILTER (external), '') AS urls FROM x GROUP BY task_id""")
def j09_file_citations(spark, sf):
    """Citations held against the file names of their own task: documents' names and short language codes."""
    d = table(spark, sf, "documents")
    task = (F.col("doc_id") % 50).alias("task_id")
    names = d.select(task, F.concat(F.lit("DOC_"), F.col("doc_id").cast("string"), F.lit(".TXT")).alias("filename")).unionByName(d.filter("doc_id % 7 = 0").select(task, F.col("lang").alias("filename")))
    c = table(spark, sf, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    url = F.concat(F.lit("https://x.example/Doc_"), (conv % 50 + 50 * turn).cast("string"), F.lit(".txt?v="), conv.cast("string"))
    cited = c.select((conv % 50).alias("task_id"), (conv * 1000 + turn).alias("citation"), F.col("text").alias("title"), F.when(turn % 5 < 4, url).alias("url"))
    return corpus.audit_citations(cited, names).select("task_id", "total", "external", "ratio", "compliant", F.array_join("external_urls", " ").alias("urls"))


@query(rf"""WITH {REPORT_SQL} SELECT conv_id, turn, coalesce(CASE WHEN conv_id % 4 = 2 THEN 'import openpyxl' || chr(10) || 'x = ' || turn END, '') AS by_library, coalesce(CASE WHEN conv_id % 4 = 2 THEN 'print()' END, '') AS by_marker FROM r""")
def f39_f40_code_blocks(spark, sf):
    return reports(spark, sf).select("conv_id", "turn", F.coalesce(text.last_library_block("report", "xlsx"), F.lit("")).alias("by_library"), F.coalesce(text.marked_block("report", "print"), F.lit("")).alias("by_marker"))


@query("SELECT conv_id, turn, 'x = {''k'': []}' || chr(10) || 'hdr_cells[0].text = ' || turn || chr(10) || 'a = t.rows[0].cells' AS code, trim(text, ' ' || chr(10)) || chr(10) || chr(10) || 'after' AS rest FROM conversations")
def f38_f41_clean_code(spark, sf):
    t = F.col("turn").cast("string")
    code = F.concat(F.lit("x = {'k' [cite: 1]: [cite: 2, 3]}\nhdr_cells.text = "), t, F.lit("[cite: 4]\na = t.rows.cells"))
    block = F.concat("text", F.lit(f"\n```python\n{text.BLOCK_START}\n"), code, F.lit(f"\n{text.BLOCK_END}\n```\nafter"))
    return table(spark, sf, "conversations").select("conv_id", "turn", text.clean_code(code).alias("code"), text.without_block(block).alias("rest"))


@query("""SELECT conv_id, CASE WHEN bool_or(turn = 0 AND role = 'system') THEN 'with' ELSE 'without' END AS kind, count(*) AS n_turns, CAST(sum(length(text) // 4) AS BIGINT) AS tokens,
string_agg(role, ' | ' ORDER BY turn, role) AS roles FROM conversations GROUP BY conv_id""")
def a24_s13_conversations(spark, sf):
    roles = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]), " | ")
    system = F.bool_or((F.col("turn") == 0) & (F.col("role") == "system"))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(F.when(system, "with").otherwise("without").alias("kind"), F.count("*").alias("n_turns"), F.sum(text.estimated_tokens("text")).alias("tokens"), roles.alias("roles"))


@query("""SELECT source, count(*) AS n_docs, count(DISTINCT lang) AS n_langs, max(n_chars) AS longest, arg_max(doc_id, (n_chars, -doc_id)) AS longest_doc FROM documents GROUP BY source""")
def a23_source_sizes(spark, sf):
    d = table(spark, sf, "documents")
    # the longest, of equal ones the least id, as a partial aggregate
    longest = F.max(F.struct("n_chars", F.col("doc_id").isNull(), -F.col("doc_id"), "doc_id"))["doc_id"]
    return d.groupBy("source").agg(F.count("*").alias("n_docs"), F.countDistinct("lang").alias("n_langs"), F.max("n_chars").alias("longest"), longest.alias("longest_doc"))


@query("""WITH f AS (SELECT conv_id, turn, role || turn || '.txt' AS filename, length(text) AS size_bytes, turn % 3 < 2 AS ok FROM conversations)
SELECT conv_id, 'The following documents have been provided for this research task:' || chr(10) || chr(10) || string_agg(CASE WHEN ok THEN '  • ' || filename || ' (txt, ' || CAST(round_even(size_bytes / 1024, 0) AS BIGINT) || ' KB)' || CASE WHEN size_bytes > 300 THEN ' [TRUNCATED]' ELSE '' END ELSE '  ❌ ' || filename || ' — ERROR: not read' END, chr(10) ORDER BY turn, filename)
|| CASE WHEN count(*) FILTER (NOT ok) > 0 THEN chr(10) || chr(10) || 'Note: ' || count(*) FILTER (NOT ok) || ' file(s) had processing issues.' ELSE '' END || chr(10) || chr(10) || 'Reference these files using [File: filename] in your citations. Treat file contents as primary source material.' AS manifest FROM f GROUP BY conv_id""")
def f43_manifest(spark, sf):
    f = table(spark, sf, "conversations").select("conv_id", "turn", F.concat("role", F.col("turn").cast("string"), F.lit(".txt")).alias("filename"), F.length("text").alias("size_bytes"), F.when(F.col("turn") % 3 >= 2, "not read").alias("error"), F.lit("txt").alias("format"))
    return corpus.manifest(f.withColumns({"truncated": F.col("size_bytes") > 300, "order": F.struct("turn", "filename")}), "conv_id", "order")
