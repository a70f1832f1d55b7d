"""Secret scans with DataFrame functions alone: patterns, and character Markov models (operator 4).

Pattern findings ("base") are the leftmost non-overlapping matches of each kind that are long enough. The
method adds findings of kind ``random``: runs of token characters that touch no base finding and whose
log-likelihood ratio under two first-order character models, one of random strings and one of ordinary
identifiers, exceeds a threshold. Both models are counted from labelled samples by one aggregation; its
result has at most 128 x 128 rows a label, which is all that reaches the driver. A pair's probability is
interpolated with that of its character classes (lower, upper, digit, other), so that a pair of letters that
no sample holds does not count as a sign of randomness.

The query labels samples itself: base values, and digests of ids as base64 and as letters and digits, are
random; words of the texts, and identifiers made of neighbouring words and numbers as programs name things
(snake, kebab and camel case, constants, paths, numbered names), are ordinary. It takes them from at most ``max_docs`` documents, those with the smallest hashes of
their ids. Every text is scanned whole.

Positions come from the lengths of matches and of the gaps between them, as running sums in blocks, so that
a text with very many matches takes about linear time. They count code points, the end exclusive.

Nulls and edge cases: a null text is empty and has no findings. Repeated rows and null ids each get a
result. Without samples every ratio is 0 and nothing is added. Columns other than the named ones are
kept as they are, whatever their names (``findings`` replaces those named like its results); an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

# fixed values: the pattern of each kind in report order, the group that holds the value, its least length
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
RANDOM = ("random", r"[A-Za-z0-9+/_=-]{16,}")
MAX_TRAIN_DOCS = 4096
#: a run counts as random beyond this log-likelihood ratio (natural logarithm)
THRESHOLD = 12.0
MASK = "[SECRET]"
_CODES = 128
#: share of the pair's own count in its probability; the rest goes to its character classes
PAIR_SHARE = 0.7
_BLOCK = 256
_EMPTY = "array<struct<start:bigint,place:int,end:bigint,kind:string>>"


def running_sums(values: Column) -> Column:
    """Running sums of an array of long, in blocks of ``_BLOCK``."""
    zero = F.lit(0).cast("long")

    def total(a: Column) -> Column:
        return F.aggregate(a, zero, lambda x, y: x + y)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int")),
                         lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))
    sums = F.transform(blocks, total)
    starts = F.transform(blocks, lambda _, b: total(F.slice(sums, F.lit(1), b)))
    return F.flatten(F.zip_with(blocks, starts, lambda block, start: F.transform(
        block, lambda _, i: start + total(F.slice(block, F.lit(1), i + 1)))))


def _at_least(least: int) -> Callable[[Column], Column]:
    return lambda v: F.length(v) >= least


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _spans(text: Column, pattern: str, matches: Column, keep: Column, kind: str, place: int) -> Column:
    """Structs (start, place, end, kind) of the matches whose flag in ``keep`` is set."""
    sizes = F.transform(matches, lambda m: F.length(m).cast("long"))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), sizes, lambda g, s: g + s)
    ends = running_sums(steps)
    found = F.zip_with(F.zip_with(ends, sizes, lambda e, s: F.struct(
        (e - s).alias("start"), F.lit(place).alias("place"), e.alias("end"), F.lit(kind).alias("kind"))), keep,
        lambda span, kept: F.struct(span.alias("span"), kept.alias("kept")))
    found = F.transform(F.filter(found, lambda x: x["kept"]), lambda x: x["span"])
    return F.when(F.exists(keep, lambda k: k), found).otherwise(F.array().cast(_EMPTY))


def _ratio(token: Column, model: Column) -> Column:
    """Log-likelihood ratio of a run of token characters (ASCII)."""
    codes = F.transform(F.split(token, ""), F.ascii)
    n = F.size(codes) - 1
    pairs = F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n),
                       lambda a, b: F.element_at(model, a * _CODES + b + 1))
    return F.aggregate(pairs, F.lit(0.0), lambda x, y: x + y)


def base_findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with an array of spans for each kind: ``_assign``, ``_access``, ``_hex``."""
    plain = F.coalesce(F.col(text), F.lit(""))
    # each step is a projection of its own, so that Spark runs every pattern once
    names = [k for k, *_ in KINDS]
    docs = docs.withColumns({f"_m_{k}": _matches(plain, p) for k, p, _, _ in KINDS})
    docs = docs.withColumns({f"_v_{k}": F.when(F.size(f"_m_{k}") > 0, _matches(plain, p, g)).otherwise(F.col(f"_m_{k}"))
                             if g else F.col(f"_m_{k}") for k, p, g, _ in KINDS})
    docs = docs.withColumns({f"_{k}": _spans(
        plain, p, F.col(f"_m_{k}"), F.transform(F.col(f"_v_{k}"), _at_least(least)), k, i)
        for i, (k, p, _, least) in enumerate(KINDS)})
    return docs.drop(*[f"_m_{k}" for k in names], *[f"_v_{k}" for k in names])


def train(samples: DataFrame) -> str:
    """The ratio of each pair of characters, comma-separated by code, from samples (token, label): 1 random,
    0 ordinary. Pairs are counted in Spark; smoothing adds one to the count of each of 66 characters."""
    codes = F.transform(F.split(F.col("token"), ""), F.ascii)
    n = F.size(codes) - 1
    pairs = F.explode(F.zip_with(F.slice(codes, F.lit(1), n), F.slice(codes, F.lit(2), n), lambda a, b: a * _CODES + b))
    counts = (samples.where(F.col("label").isNotNull() & (F.length("token") > 1))
              .where(~F.col("token").rlike(r"[^\x00-\x7F]"))
              .select("label", pairs.alias("pair")).groupBy("label", "pair").count())
    seen: list[dict[int, int]] = [{}, {}]
    for r in counts.collect():  # at most 2 x 128 x 128 rows
        seen[1 if r.label else 0][r.pair] = r["count"]
    ratio = [0.0] * (_CODES * _CODES)
    if seen[0] and seen[1]:
        odds = [_log_probabilities(counts) for counts in seen]
        ratio = [round(one - zero, 4) for zero, one in zip(*odds)]
    return ",".join(map(str, ratio))


def _class_of(code: int) -> int:
    c = chr(code)
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


#: fixed values: the characters of a token, beside letters and digits
_TOKEN = [ord(c) for c in "+/_=-."] + [c for c in range(_CODES) if chr(c).isalnum()]
_CLASS_SIZE = [sum(_class_of(c) == k for c in _TOKEN) for k in range(4)]


def _log_probabilities(counts: dict[int, int]) -> list[float]:
    """Log-probability of the second character of each pair after the first, from counts of pairs."""
    out, classes = [0] * _CODES, [[1.0] * 4 for _ in range(4)]
    for pair, n in counts.items():
        a, b = divmod(pair, _CODES)
        out[a] += n
        classes[_class_of(a)][_class_of(b)] += n
    logs = []
    for pair in range(_CODES * _CODES):
        a, b = divmod(pair, _CODES)
        row, kind = classes[_class_of(a)], _class_of(b)
        by_class = row[kind] / sum(row) / _CLASS_SIZE[kind]
        share = PAIR_SHARE if out[a] else 0.0
        logs.append(math.log(share * counts.get(pair, 0) / max(1, out[a]) + (1 - share) * by_class))
    return logs


def labelled_samples(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> DataFrame:
    """Samples (token, label) from at most ``max_docs`` ids: base values and digests are random, words and
    identifiers made of them are ordinary."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().select(
        "doc_id", F.xxhash64(F.lit(4), F.col("doc_id")).alias("place")).orderBy("place", "doc_id").limit(max_docs)
    # max_docs rows of two numbers
    some = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id")), "doc_id")
    plain = F.coalesce(F.col("text"), F.lit(""))
    values = F.concat(*[F.filter(_matches(plain, p, g), _at_least(least)) for _, p, g, least in KINDS])
    base64 = F.base64(F.unhex(F.sha2(F.col("doc_id").cast("string"), 256)))
    words = F.regexp_extract_all(plain, F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z_]{3,}(?![A-Za-z0-9+/=-])"), F.lit(0))
    some = some.select(F.col("doc_id"), F.concat(values, F.array(base64, F.regexp_replace(base64, "[^A-Za-z0-9]", ""))).alias("random"),
                       words.alias("words"))
    random = some.select(F.explode("random").alias("token"), F.lit(1).alias("label"))
    return random.unionByName(some.select(F.explode(_identifiers(F.col("words"), F.col("doc_id"))).alias("token"), F.lit(0).alias("label")))


def _identifiers(words: Column, seed: Column) -> Column:
    """The words, and for each two that follow each other one identifier in a style that goes with its place."""
    n = F.size(words) - 1

    def joined(a: Column, i: Column) -> Column:
        b = F.get(words, i + 1)
        number = F.pmod(F.xxhash64(seed, i), F.lit(10 ** 9)).cast("string")
        short = F.right(number, F.lit(4))
        camel = F.concat(F.lower(a), F.initcap(b))
        styles = [F.concat_ws("_", F.lower(a), F.lower(b), number), F.concat_ws("-", F.lower(a), F.lower(b), short),
                  F.concat(camel, short), F.concat(camel, F.initcap(a)), F.upper(F.concat_ws("_", a, b)),
                  F.concat(F.lit("/"), F.concat_ws("/", F.lower(a), F.concat(F.lower(b), F.right(number, F.lit(1))), F.concat_ws("-", F.lower(b), F.lower(a)))),
                  F.concat(F.upper(F.left(a, F.lit(4))), number, short), F.concat(F.initcap(a), F.initcap(b), F.lit("="), short)]
        return F.element_at(F.array(*styles), (F.pmod(F.xxhash64(i, seed), F.lit(len(styles))) + 1).cast("int"))

    return F.concat(words, F.when(n > 0, F.transform(F.slice(words, F.lit(1), F.greatest(n, F.lit(1))), joined)).otherwise(
        F.array().cast("array<string>")))


def _model(ratios: str) -> Column:
    return F.split(F.lit(ratios), ",").cast("array<double>")  # folded to one literal by the optimizer


def _replaced(docs: DataFrame, column: str, pattern: str, new: Callable[[Column], Column],
              where: Column | None = None) -> DataFrame:
    """``docs`` with the matches in ``column`` replaced by ``new`` of each; only rows under ``where`` are searched."""
    old = _matches(F.col(column), pattern)
    if where is not None:
        old = F.when(where, old).otherwise(F.array().cast("array<string>"))
    # gap, match, gap, ...: the gaps are one more
    joined = F.array_join(F.flatten(F.zip_with(F.split(column, pattern, -1), F.col("_new"),
                                               lambda g, m: F.array(g, F.coalesce(m, F.lit(""))))), "")
    return (docs.withColumn("_old", old).withColumn("_new", F.transform("_old", new))
            .withColumn(column, F.when(F.col("_new") != F.col("_old"), joined).otherwise(F.col(column)))
            .drop("_old", "_new"))


def _blank(pattern: str, group: int, least: int) -> Callable[[Column], Column]:
    def new(m: Column) -> Column:
        value = F.regexp_extract(m, pattern, group) if group else m
        return F.when(F.length(value) >= least, F.repeat(F.lit(" "), F.length(m))).otherwise(m)
    return new


def findings(docs: DataFrame, ratios: str, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` with ``_assign``, ``_access``, ``_hex`` and ``_random``, arrays of spans. Runs for ``_random``
    are looked for where the base findings are blanked out."""
    columns = docs.columns
    docs = base_findings(docs.select(F.struct(*columns).alias("_row"), F.col(text).alias("_text")), "_text")
    text = "_text"
    any_base = F.size("_assign") + F.size("_access") + F.size("_hex") > 0
    docs = docs.withColumn("_rest", F.coalesce(F.col(text), F.lit("")))
    for _, pattern, group, least in KINDS:
        docs = _replaced(docs, "_rest", pattern, _blank(pattern, group, least), any_base)
    kind, pattern = RANDOM
    docs = docs.withColumn("_m", _matches(F.col("_rest"), pattern))
    docs = docs.withColumn("_k", F.transform("_m", lambda m: _ratio(m, _model(ratios)) > threshold))
    spans = _spans(F.col("_rest"), pattern, F.col("_m"), F.col("_k"), kind, len(KINDS))
    results = [*[f"_{k}" for k, *_ in KINDS], "_random"]
    return docs.withColumn("_random", spans).select(*[F.col("_row")[c].alias(c) for c in columns if c not in results], *results)


def listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _masked(kind: str, pattern: str, group: int, least: int, ratios: str, threshold: float) -> Callable[[Column], Column]:
    """From a match to what stands in its place."""
    if kind == RANDOM[0]:
        return lambda m: F.when(_ratio(m, _model(ratios)) > threshold, MASK).otherwise(m)
    if group:
        return lambda m: F.when(F.length(F.regexp_extract(m, pattern, group)) >= least,
                                F.concat(F.regexp_extract(m, pattern, 1), F.lit(MASK))).otherwise(m)
    return lambda m: F.when(F.length(m) >= least, MASK).otherwise(m)


def redact(docs: DataFrame, ratios: str, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by a mask (of an assignment, its value), and
    ``n_chars`` counted anew in changed texts if there is such a column. Null texts stay null."""
    columns = docs.columns
    found = docs.select(F.struct(*columns).alias("_row"), F.col("text").alias("_text"))
    for kind, pattern, group, least in [*KINDS, (*RANDOM, 0, 0)]:
        found = _replaced(found, "_text", pattern, _masked(kind, pattern, group, least, ratios, threshold))
    row, text = F.col("_row"), F.col("_text")
    new = {"text": text}
    if "n_chars" in columns:
        new["n_chars"] = F.when(text != row["text"], F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(row["n_chars"])
    return found.select(*[new.get(c, row[c]).alias(c) for c in columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratios = train(labelled_samples(docs))
    found = findings(docs.select("doc_id", "text"), ratios)
    base = F.concat("_assign", "_access", "_hex")
    return found.select("doc_id", *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k, *_ in KINDS],
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
                        listed(F.concat(base, F.col("_random"))).alias("spans"))
