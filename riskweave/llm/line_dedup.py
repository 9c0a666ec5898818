"""Line dedup: hashes of lines range-partitioned, first occurrences streamed, bitmaps returned.

Each line becomes two 64-bit hashes of its key, the document and the position; the text
stays where it is. The hashes are dealt by range and sorted by hash, document and position
inside a range, so that a window that looks no further back than the current row finds the
first holder of each key as the rows stream by. What returns to the documents is a bitmap
of 64-line words per document, in which words without a dropped line are left out.

A key that holds a large share of all lines would fill one range. Such keys are found by a
count with a fixed number of counters; their first holders come from a map-side minimum,
one row per key and task, and their lines are compared with that short list in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import SPACE_CHARS, fresh, lower_ascii
from riskweave.session import materialize

#: Keys shorter than this (in code points) are never dropped.
LEAST_KEY = 10
#: A key with at least this share of the lines takes the route for hot keys. At most
#: 1 / HOT_SHARE keys can have it, which bounds the list that is broadcast.
HOT_SHARE = 0.0005
_LAST_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """What two equal lines share: no ASCII white space at the ends, A-Z lower-cased."""
    return F.btrim(lower_ascii(line), F.lit(SPACE_CHARS))


def _holder(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    """Identity of a row: its id (null as the largest) and a digest of its text."""
    return [
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_LAST_ID)).alias("_doc"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_tag"),
    ]


def line_hashes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_key: int = LEAST_KEY
) -> DataFrame:
    """(_h1, _h2, _doc, _tag, _pos) for each line whose key is long enough."""
    whole = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    lines = docs.select(
        *_holder(docs, doc_id, text), F.posexplode(F.split(whole, "\n")).alias("_pos", "_line")
    )
    key = F.btrim(F.col("_line"), F.lit(SPACE_CHARS))
    keyed = lines.select("_doc", "_tag", "_pos", key.alias("_key"))
    return keyed.where(F.char_length("_key") >= least_key).select(
        F.xxhash64("_key").alias("_h1"),
        F.xxhash64(F.lit("second"), F.col("_key")).alias("_h2"),
        "_doc",
        "_tag",
        "_pos",
    )


def _dropped(hashes: DataFrame, hot_share: float) -> DataFrame:
    """(_doc, _tag, _pos) of every line that a smaller document also holds."""
    found = hashes.stat.freqItems(["_h1"], hot_share).first()
    hot = F.col("_h1").isin(list(found[0] or []) if found else [])
    mine = hashes.where(hot)
    first = mine.groupBy("_h1", "_h2").agg(F.min("_doc").alias("_first"))
    by_list = mine.join(F.broadcast(first), ["_h1", "_h2"])
    running = (
        Window.partitionBy("_h1", "_h2")
        .orderBy("_doc", "_pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    by_stream = (
        hashes.where(~hot)
        .repartitionByRange("_h1", "_h2")
        .withColumn("_first", F.first("_doc").over(running))
    )
    late = F.col("_doc") > F.col("_first")
    names = ["_doc", "_tag", "_pos"]
    return by_stream.where(late).select(*names).unionByName(by_list.where(late).select(*names))


def keep_bitmaps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    least_key: int = LEAST_KEY,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """One row (_doc, _tag, keep_bitmap) per document that loses a line.

    ``keep_bitmap`` is an array of (word, bits): bit b of word w is set where line
    64 w + b stays. Words in which every line stays are left out, and so are documents
    that keep all their lines. ``_doc`` is the id, ``_tag`` a digest of the text, so that
    rows that repeat an id keep bitmaps of their own.
    """
    hashes = materialize(line_hashes(docs, doc_id, text, least_key), "line-hashes")
    word = F.floor(F.col("_pos") / 64).cast("int")
    bit = F.expr("shiftleft(1L, _pos % 64)")
    return (
        _dropped(hashes, hot_share)
        .select("_doc", "_tag", word.alias("word"), bit.alias("bit"))
        .repartition("_doc", "_tag")
        .groupBy("_doc", "_tag", "word")
        .agg(F.bitwise_not(F.bit_or("bit")).alias("bits"))
        .groupBy("_doc", "_tag")
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep_bitmap"))
    )


def _dense(bitmap: Column) -> Column:
    """The bits of word 0, 1, ... up to the last one listed; -1 where a word is left out."""
    last = F.element_at(bitmap, -1)["word"]
    listed = F.map_from_entries(bitmap)
    return F.transform(
        F.sequence(F.lit(0), last), lambda w: F.coalesce(listed[w], F.lit(-1).cast("bigint"))
    )


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``text`` cut down to the lines that stay, and n_lines, n_dropped.

    A null text counts as one empty line and becomes an empty text. Columns already
    called n_lines or n_dropped are replaced.
    """
    own = docs.drop("n_lines", "n_dropped")
    doc, tag, mask, left = fresh(own, "doc", "tag", "bits", "kept")
    holder = zip(_holder(own, doc_id, text), (doc, tag), strict=True)
    held = own.select("*", *[c.alias(n) for c, n in holder])
    dense = bitmaps.select(
        F.col("_doc").alias(doc), F.col("_tag").alias(tag), _dense(F.col("keep_bitmap")).alias(mask)
    )
    joined = held.join(dense, [doc, tag], "left")
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")

    def stays(_line: Column, at: Column) -> Column:
        bits = F.coalesce(F.get(mask, F.floor(at / 64).cast("int")), F.lit(-1).cast("bigint"))
        return F.expr("1L").bitwiseAND(F.call_function("shiftright", bits, at % 64)) == 1

    kept = F.when(F.col(mask).isNull(), lines).otherwise(F.filter(lines, stays))
    cut = joined.select(
        *own.columns, F.size(lines).cast("bigint").alias("n_lines"), kept.alias(left)
    )
    return cut.withColumn(
        "n_dropped", F.col("n_lines") - F.size(left).cast("bigint")
    ).select(
        *[F.array_join(left, "\n").alias(c) if c == text else c for c in own.columns],
        "n_lines",
        "n_dropped",
    )


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings
) -> DataFrame:
    """``docs`` without the lines that a document with a smaller id also holds.

    Lines are equal if their keys are; keys under ``least_key`` code points stay. A key's
    lines all stay in the smallest id that holds it, and a row without an id counts as the
    largest. Rows that share an id count as one document.
    """
    return apply_bitmaps(docs, keep_bitmaps(docs, doc_id, text, **settings), doc_id, text)


def op1(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    cut = dedup_lines(docs.select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
with lines as (
  select row_number() over () as row, doc_id, coalesce(doc_id, 9223372036854775807) as holder,
         unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select row, doc_id, holder, line, pos,
         trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key
  from lines),
firsts as (select key, min(holder) as first_doc from keyed where length(key) >= 10 group by key),
marked as (
  select k.*, coalesce(k.holder > f.first_doc, false) as dropped
  from keyed k left join firsts f on k.key = f.key)
select doc_id, count(*) as n_lines, cast(sum(dropped::int) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from marked group by row, doc_id
"""
