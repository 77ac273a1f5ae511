"""Sources and sinks: page texts, PDF files through a hook, JSON arrays, curated records, vector indexes."""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter
from tempfile import TemporaryFile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import lexicons as lex
from millrace.functions import text as T

#: Takes a file's bytes, or an iterator of blocks of them, and yields (page number, text).
PageReader = Callable[[bytes], Iterable[tuple[int, str]]] | Callable[[Iterator[bytes]], Iterable[tuple[int, str]]]
#: Bytes of a block in which files go to Python; characters of pages, and pages, that come back at once.
BLOCK, PAGE_CHARS, PAGES = 2_048, 1 << 20, 4_096


def text_pages(data: bytes | Iterable[bytes]) -> Iterator[tuple[int, str]]:
    """The page reader of plain text files, whole or in blocks: pages end in form feeds. One page is held at a time."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    n, page = 1, []
    for block in [data] if isinstance(data, bytes) else data:
        *ends, last = decoder.decode(block).split("\f")
        for t in ends:
            yield n, "".join([*page, t])
            n, page = n + 1, []
        page.append(last)
    yield n, "".join([*page, decoder.decode(b"", True)])


def pdf_pages(data: bytes) -> Iterator[tuple[int, str]]:
    """The page reader of PDF files; needs an installed PDF library on the executors."""
    import io

    import pdfplumber

    with pdfplumber.open(io.BytesIO(data)) as pdf:
        for n, page in enumerate(pdf.pages, 1):
            yield n, page.extract_text() or ""


def mupdf_pages(data: bytes) -> Iterator[tuple[int, str]]:
    """The page reader of PDF files by another layout engine; needs its library on the executors."""
    import fitz

    with fitz.open(stream=data, filetype="pdf") as pdf:
        for n, page in enumerate(pdf, 1):
            yield n, page.get_text() or ""


_PAGE_ROWS = pa.schema([("doc", pa.string()), ("page_num", pa.int32()), ("text", pa.string()), ("error", pa.string())])


def _page_rows(doc: str, pages: Iterable[tuple[int, str]]) -> Iterator[pa.RecordBatch]:
    """Rows of a file's pages that are not blank, few at once."""
    made = lambda ns, ts: pa.RecordBatch.from_arrays([pa.array([doc] * len(ns)), pa.array(ns, pa.int32()), pa.array(ts, pa.string()), pa.nulls(len(ns), pa.string())], schema=_PAGE_ROWS)
    ns, ts, size = [], [], 0
    for n, t in pages:
        if t and (t := t.strip()):
            ns.append(n)
            ts.append(t)
            size += len(t)
            if size >= PAGE_CHARS or len(ns) >= PAGES:
                yield made(ns, ts)
                ns, ts, size = [], [], 0
    if ns:
        yield made(ns, ts)


def read_pages(spark: SparkSession, path: str, reader: PageReader = pdf_pages, pattern: str = "*.pdf", name: str | None = None, blocks: bool = False) -> DataFrame:
    """doc (file name), page_num, text, error of all files below `path` that match; blank pages are dropped.

    `name`: a pattern whose first group in the file's path is the document's name instead.
    `blocks`: the reader takes an iterator of blocks of the file's bytes; then no file is whole in a worker.

    A file that can't be read gives one row with its error and no page, and harms no other: its pages wait in a
    temporary file until it has been read. A folder without such files gives no rows; a missing one too."""
    def received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            files, parts = batch.columns
            for k in range(batch.num_rows):
                yield files[k].as_py(), parts[k].as_py()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, own in groupby(received(batches), itemgetter(0)):
            doc = file.rsplit("/", 1)[-1] if name is None else (re.search(name, file) or [file, file])[1]
            parts = map(itemgetter(1), own)
            with TemporaryFile() as held:
                try:
                    with pa.ipc.new_stream(held, _PAGE_ROWS) as out:
                        for rows in _page_rows(doc, reader(parts if blocks else b"".join(parts))):
                            out.write_batch(rows)
                except Exception as e:  # quarantined
                    yield pa.RecordBatch.from_pylist([{"doc": doc, "error": f"{type(e).__name__}: {e}"[:500]}], schema=_PAGE_ROWS)
                    continue
                held.seek(0)
                yield from pa.ipc.open_stream(held)

    schema = "doc string, page_num int, text string, error string"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    # an Arrow batch holds some thousands of rows: rows of blocks bound it, rows of files don't; an empty file is one block
    starts = lambda c: F.sequence(F.lit(1), F.greatest(F.octet_length(c), F.lit(1)), F.lit(BLOCK))
    cut = T.let(F.col("content"), lambda c: F.transform(starts(c), lambda at: F.substring(c, at, F.lit(BLOCK))))
    return files.select("path", F.explode(cut).alias("part")).mapInArrow(scan, schema)


def pages_and_errors(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable pages, and the files that failed with their errors."""
    return pages.filter("error is null").drop("error"), pages.filter("error is not null").select("doc", "error")


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of files that each hold one JSON array; fields that are missing are null."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_json(df: DataFrame, path: str) -> None:
    """Records as JSON lines, non-ASCII characters as they are."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_json_array(df: DataFrame, path: str, parts: int | None = None) -> None:
    """Records as JSON arrays: each file of the folder `path` is one array, which `read_json_array` reads.

    Every task writes the files of its own rows as they come, and Spark's commit makes them visible together; parts=1
    gives one file, for consumers that need that. An empty table gives an empty array."""
    record = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for batch in batches:
            values = batch.column(0).to_pylist()
            if values:
                lines = [("," if opened or k else "[") + v for k, v in enumerate(values)]
                opened = True
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]"] if opened else ["[]"], pa.string())], names=["value"])

    (record.coalesce(parts) if parts else record).mapInArrow(bracketed, "value string").write.mode("overwrite").text(path)


def first_existing(spark: SparkSession, paths: Iterable[str]) -> str | None:
    """The first of the paths that exists."""
    for p in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(p)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            return p
    return None


def sample_texts(spark: SparkSession, pages: DataFrame | None, records: DataFrame | None, advised: int = 5) -> tuple[DataFrame, str | None]:
    """Texts to calibrate on: pages if there are any, else records; and a warning if they are few. An error if
    there are neither."""
    for df, column in ((pages, "text"), (records, "content")):
        if df is not None and (n := df.limit(advised).count()):
            return df.select(F.col(column).alias("text")), f"only {n} documents to calibrate on" if n < advised else None
    raise ValueError("neither pages nor records to calibrate on")


def stable_id(prefix: str, *of: Column) -> Column:
    """A record id that depends on its key only."""
    return F.concat(F.lit(f"{prefix}-"), F.upper(F.substring(F.sha2(F.concat_ws("\u0001", *of), 256), 1, 12)))


def adapt_records(v3: DataFrame) -> DataFrame:
    """Curated records with the fields that later stages expect; no row is added or lost.

    v3: ako_id, domain, source_file, entity_type, title, content, metadata(key_entities, target_audience),
    content_hash, extraction_version, last_updated."""
    table = F.create_map(*[F.lit(x) for kv in lex.ENTITY_CATEGORIES.items() for x in kv])
    e = lambda c: F.coalesce(F.col(c), F.lit(""))
    return v3.select(
        e("ako_id").alias("ako_id"), F.lit("institutional").alias("type"), F.coalesce(F.try_element_at(table, F.col("entity_type")), F.lit("general")).alias("category"),
        e("title").alias("section_title"), e("title").alias("llm_title"), e("content").alias("content"), F.array().cast("array<string>").alias("program_scope"),
        F.coalesce(F.col("metadata.target_audience"), F.array(F.lit("Students"))).alias("audience"), e("source_file").alias("source_file"), F.lit("").alias("pages"),
        e("last_updated").alias("last_updated"), F.lit(0.85).alias("semantic_purity_score"), F.coalesce("extraction_version", F.lit("v3.0_intent_aligned")).alias("cleanup_version"),
        F.coalesce(F.nullif(F.col("content_hash"), F.lit("")), F.md5("content")).alias("content_hash"), F.coalesce("domain", F.lit("institutional")).alias("domain"), e("entity_type").alias("entity_type"),
        F.coalesce(F.col("metadata.key_entities"), F.array().cast("array<string>")).alias("key_entities"), e("extraction_version").alias("extraction_version"),
    )
