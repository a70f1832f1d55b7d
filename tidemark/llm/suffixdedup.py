"""Exact removal of repeated byte strings by sampled suffixes and adjacent prefixes (operator 1).

A byte goes if a ``length``-byte string that covers it also starts anywhere else in the corpus. As in a
difference-cover suffix sort, only sampled suffixes are named and the others are placed by the next sampled
one; but the cover is drawn by content, not by position modulo three, and names are fingerprints:

1. Sample: in every window of ``length`` bytes, the leftmost least of its hashed ``GRAM``-byte strings. Two
   equal windows have their sample at the same offset, as a difference cover guarantees for positions.
2. Names: fingerprints of the sampled strings, counted over the corpus. A window whose sample has a name
   that occurs once cannot repeat and is left out (nothing else is).
3. Recursion: the same with ``LONG_GRAM``-byte names, over the windows that are left.
4. Merge: the windows around one sample (at most ``length`` + the sample's offset bytes) are placed by its
   name and their offset from it. Equal surroundings are one row with a count.
5. Adjacent prefixes: rows of one name meet in one task, where windows are sorted by offset and fingerprint
   and compared with their neighbours. Names with more than ``HOT`` surroundings go through an aggregation
   by window instead, which combines map-side. Fingerprints that decide have 64 bits within a name, 128 in
   that aggregation.

Texts that are equal as a whole are one text: every byte of it goes if it has ``length`` bytes.

Nulls and edge cases: a null text is empty. Texts shorter than ``length`` keep every byte. Rows with equal
texts are different places, whatever their ids, so both go. Strings never cross rows. Very long texts are
taken whole. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, _power_tables, mix64, table, text_buffers

GRAM, LONG_GRAM = 32, 300
HOT = 2000
BUCKET_ROWS = 3000
_BIG = np.uint64(0xFFFFFFFFFFFFFFFF)


def _prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial hash (one longer than ``data``) and the inverse powers that place-free it."""
    power, inverse = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    return total, inverse


def _gram_hashes(total: np.ndarray, inverse: np.ndarray, gram: int) -> np.ndarray:
    return mix64((total[gram:] - total[:-gram]) * inverse[:len(total) - gram])


def _window_least(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, from running minima of blocks in both directions."""
    blocks = -(-len(h) // width)
    padded = np.full(blocks * width, _BIG)
    padded[:len(h)] = h
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:len(h) - width + 1], ahead[width - 1:len(h)])


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of equal values."""
    cuts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return cuts, np.r_[cuts[1:], len(values)]


def _in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


class _Text:
    """Samples of one text of at least ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.total, self.inverse = _prefix_hashes(data)

    def least(self, gram: int) -> tuple[np.ndarray, np.ndarray]:
        h = _gram_hashes(self.total, self.inverse, gram)
        return h, _window_least(h, self.length - gram + 1)

    def names(self, gram: int, windows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(name, how often) of the samples of the chosen windows."""
        h, least = self.least(gram)
        starts, _ = _runs(least)
        chosen = np.unique(least[starts] if windows is None else least[windows])
        return np.unique(h[_in(h, chosen)], return_counts=True)


def _packed(names: np.ndarray, counts: np.ndarray) -> list[dict]:
    return [{"name": n, "n": c} for n, c in zip(names.view(np.int64).tolist(), counts.tolist())]


_NAMES = pa.list_(pa.struct([("name", pa.int64()), ("n", pa.int64())]))


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray]]:
    data, offs = text_buffers(batch.column(column))
    for k in range(batch.num_rows):
        yield k, data[offs[k]:offs[k + 1]]


def _described(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, n_bytes, text_key (128-bit digest), sha256 of the whole text, names (of texts long enough)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, data in _texts(batch, 1):
                raw = data.tobytes()
                names = _packed(*_Text(data, length).names(GRAM)) if len(data) >= length else []
                rows.append((len(data), hashlib.blake2b(raw, digest_size=16).digest(), hashlib.sha256(raw).hexdigest(), names))
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.binary(), pa.string(), _NAMES)))],
                names=["doc_id", "n_bytes", "text_key", "sha256", "names"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_bytes long, text_key binary, sha256 string, names array<struct<name:bigint,n:bigint>>")


def _repeated_names(named: DataFrame) -> DataFrame:
    """(text_key, hits): the names of each text (text_key, names) that occur more than once in the corpus."""
    each = named.select("text_key", F.explode("names").alias("x")).select("text_key", "x.name", "x.n")
    repeated = each.groupBy("name").agg(F.sum("n").alias("total")).where("total > 1").select("name")
    # a text's names are no more than its bytes
    return each.select("text_key", "name").join(repeated, "name").groupBy("text_key").agg(
        F.collect_list("name").alias("hits"))


def _hits(column: pa.Array, k: int) -> np.ndarray:
    return np.sort(column[k].values.to_numpy(zero_copy_only=False).view(np.uint64))


def _long_names(texts: DataFrame, length: int) -> DataFrame:
    """(text_key, names): long names of the windows whose short name is among the text's hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, data in _texts(batch, 1):
                text = _Text(data, length)
                windows = _in(text.least(GRAM)[1], _hits(batch.column(2), k))
                out.append(_packed(*text.names(LONG_GRAM, windows)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, _NAMES)], names=["text_key", "names"])

    return texts.select("text_key", "text", "hits").mapInArrow(
        run, "text_key binary, names array<struct<name:bigint,n:bigint>>")


def _samples(texts: DataFrame, length: int) -> DataFrame:
    """Per text and distinct surroundings of a sample: text_key, name, around (digest), low and high (offsets
    of its windows), lead (bytes before the sample), bytes, places (positions of the sample in the text)."""
    reach = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, data in _texts(batch, 1):
                text = _Text(data, length)
                h, least = text.least(GRAM)
                left = _in(least, _hits(batch.column(2), k)) & _in(text.least(LONG_GRAM)[1], _hits(batch.column(3), k))
                raw = data.tobytes()
                found: dict[tuple, list[int]] = {}
                starts, ends = _runs(least)
                some = np.r_[0, np.cumsum(left)]
                for s, e in zip(starts[some[ends] > some[starts]].tolist(), ends[some[ends] > some[starts]].tolist()):
                    before = s
                    for p in (np.flatnonzero(h[s:e + reach] == least[s]) + s).tolist():
                        a, b = before, min(p, e - 1)  # windows a..b have the sample p
                        before = p + 1
                        if a <= b and some[b + 1] > some[a]:
                            around = raw[a:b + length]
                            key = (int(h[p]), hashlib.blake2b(around + bytes([(p - a) & 255, (p - a) >> 8]), digest_size=16).digest())
                            if key not in found:
                                found[key] = [p - b, p - a, a, []]
                            found[key][3].append(p)
                        if before >= e:
                            break
                rows = [(name - (1 << 64) if name >> 63 else name, around, low, high, raw[a:a + high - low + length], places)
                        for (name, around), (low, high, a, places) in found.items()]
                if rows:
                    columns = list(zip(*rows))
                    types = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[k].as_py()] * len(rows), pa.binary()),
                         *(pa.array(c, t) for c, t in zip(columns, types))],
                        names=["text_key", "name", "around", "low", "high", "bytes", "places"])

    return texts.select("text_key", "text", "hits", "long_hits").mapInArrow(
        run, "text_key binary, name long, around binary, low int, high int, bytes binary, places array<long>")


def _windows(names: np.ndarray, low: np.ndarray, high: np.ndarray, raw: list[bytes], length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset, fingerprint) of every window of the rows; the fingerprint covers name and offset too."""
    sizes = np.array([len(r) for r in raw], np.int64)
    total, inverse = _prefix_hashes(np.frombuffer(b"".join(raw), np.uint8))
    n = high - low + 1
    row = np.repeat(np.arange(len(raw)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = (np.cumsum(sizes) - sizes)[row] + step
    offset = high[row] - step
    h = (total[start + length] - total[start]) * inverse[start]
    odd = np.uint64(0x9E3779B97F4A7C15) + np.uint64(2 * seed)
    return row, offset, mix64(mix64(h ^ np.uint64(seed)) * odd + mix64(names.view(np.uint64)[row] + offset.astype(np.uint64)))


def _marked(surroundings: DataFrame, length: int) -> DataFrame:
    """(name, around, marks): offsets whose windows repeat, of rows whose whole name group meets in a task."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        names, low, high, n = (group.column(c).to_numpy().astype(np.int64) for c in ("name", "low", "high", "n"))
        marks: list[list[int]] = [[] for _ in range(len(names))]
        row, offset, key = _windows(names, low, high, group.column("bytes").to_pylist(), length, 1)
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice |= n[row] > 1
        hit = np.flatnonzero(twice)
        cuts = np.searchsorted(row[hit], np.arange(len(names) + 1))
        marks = [offset[hit[a:b]].astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.table({"name": group.column("name"), "around": group.column("around"),
                         "marks": pa.array(marks, pa.list_(pa.int32()))})

    return surroundings.groupBy("bucket").applyInArrow(run, "name long, around binary, marks array<int>")


def _marked_hot(surroundings: DataFrame, length: int) -> DataFrame:
    """The same for names with very many surroundings, by an aggregation over windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                names, low, high, n = (part.column(c).to_numpy().astype(np.int64) for c in (0, 2, 3, 5))
                raw = part.column(4).to_pylist()
                row, offset, one = _windows(names, low, high, raw, length, 1)
                _, _, two = _windows(names, low, high, raw, length, 2)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(offset.astype(np.int32)),
                     pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(n[row])],
                    names=["name", "around", "offset", "one", "two", "n"])

    each = surroundings.select("name", "around", "low", "high", "bytes", "n").mapInArrow(
        run, "name long, around binary, offset int, one long, two long, n long")
    again = each.groupBy("one", "two").agg(F.sum("n").alias("total")).where("total > 1").select("one", "two")
    # at most length offsets a row
    return each.join(again, ["one", "two"], "left_semi").groupBy("name", "around").agg(F.collect_list("offset").alias("marks"))


def deduplicated(docs: DataFrame, length: int = 400) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end of each
    removed run, in bytes)."""
    scratch = Scratch(docs.sparkSession, "suffix")
    described = scratch.write(_described(docs, length), "described")
    texts = described.where(F.col("n_bytes") >= length).groupBy("text_key").agg(
        F.count("*").alias("copies"), F.min(F.coalesce("doc_id", F.lit(-1 << 62))).alias("doc"))
    texts = scratch.write(texts, "texts")
    own = F.coalesce("doc_id", F.lit(-1 << 62)).alias("doc")
    named = described.select("text_key", own, "names").join(texts, ["text_key", "doc"]).dropDuplicates(["text_key"])
    hits = scratch.write(_repeated_names(named.select("text_key", "names")), "hits")
    raw = docs.select(own, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    chosen = hits.join(texts.select("text_key", "doc"), "text_key")
    # an id on several texts brings other texts too: the digest, taken again, tells
    candidates = raw.join(chosen, "doc").mapInArrow(_of_key, "text_key binary, text binary, hits array<long>")
    candidates = scratch.write(candidates.dropDuplicates(["text_key"]), "candidates")
    long_hits = _repeated_names(_long_names(candidates, length)).withColumnRenamed("hits", "long_hits")
    samples = scratch.write(_samples(candidates.join(long_hits, "text_key"), length), "samples")
    scratch.drop(candidates)

    around = samples.groupBy("name", "around").agg(
        F.sum(F.size("places")).cast("long").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"),
        F.first("bytes").alias("bytes"))
    around = scratch.write(around, "surroundings")
    by_name = around.groupBy("name").agg(F.count("*").alias("rows"))
    hot = scratch.write(by_name.where(F.col("rows") > HOT).select("name"), "hot")
    buckets = max(1, around.count() // BUCKET_ROWS)
    usual = around.join(hot, "name", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("name"), F.lit(buckets)))
    marks = _marked(usual, length).unionByName(_marked_hot(around.join(hot, "name", "left_semi"), length))
    marks = scratch.write(marks.where(F.size("marks") > 0), "marks")
    # a group is one text
    places = samples.select("text_key", "name", "around", "places").join(marks, ["name", "around"]).groupBy("text_key").agg(
        F.collect_list(F.struct("places", "marks")).alias("found"))
    affected = places.join(texts.where("copies = 1"), "text_key")
    spans = raw.join(affected.select("doc", "text_key", "found"), "doc").mapInArrow(
        lambda batches: _spans(batches, length), "text_key binary, spans array<struct<start:bigint,end:bigint>>, kept string")
    spans = spans.dropDuplicates(["text_key"])
    whole = texts.where("copies > 1").select("text_key", F.lit(True).alias("all"))
    every = described.select("doc_id", "n_bytes", "text_key", "sha256").join(spans, "text_key", "left").join(whole, "text_key", "left")
    one = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    gone = F.when(F.col("all"), one).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")))
    kept = F.when(F.col("all"), hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("kept", "sha256"))
    return every.select("doc_id", "n_bytes", gone.alias("spans"), kept.alias("kept_sha256")).select(
        "doc_id", "n_bytes", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), "kept_sha256", "spans")


def _of_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, text, text_key, hits) whose text has that digest, as (text_key, text, hits)."""
    for batch in batches:
        keys = batch.column(batch.schema.get_field_index("text_key")).to_pylist()
        column = batch.schema.get_field_index("text")
        good = [hashlib.blake2b(data.tobytes(), digest_size=16).digest() == keys[k] for k, data in _texts(batch, column)]
        yield batch.select(["text_key", "text", "hits"]).filter(pa.array(good, pa.bool_()))


def _spans(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The removed runs and the digest of what is kept, of rows (doc, text, text_key, found)."""
    for batch in batches:
        at = {c: batch.schema.get_field_index(c) for c in ("text", "text_key", "found")}
        rows = []
        for k, data in _texts(batch, at["text"]):
            raw, key = data.tobytes(), batch.column(at["text_key"])[k].as_py()
            if hashlib.blake2b(raw, digest_size=16).digest() != key:
                continue
            change = np.zeros(len(data) + 1, np.int64)
            for item in batch.column(at["found"])[k]:
                places = item["places"].values.to_numpy(zero_copy_only=False)
                starts = (places[:, None] - item["marks"].values.to_numpy(zero_copy_only=False)[None]).reshape(-1)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.r_[False, gone, False]))
            spans = [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
            rows.append((key, spans, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
        columns = list(zip(*rows)) if rows else [[]] * 3
        types = (pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["text_key", "spans", "kept"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).drop("spans")
