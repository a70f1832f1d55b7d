"""BPE encoding and decoding in batched numpy merge rounds (operator 9).

A batch of words is one flat array of symbols with word boundaries. In every round, each adjacent pair
inside a word is looked up by binary search over the sorted pair keys; the lowest rank of each word is
found, and all its occurrences (left to right, not overlapping) merge at once. Words leave when no pair is
left. Only words that a task has not met lately go through the rounds.

The tokenizer file names the vocabulary, the merges, the word pattern and the special tokens; its path is a
parameter and each task reads it once. Supported files: BPE with an end-of-word suffix, NFC, white space to
one blank, lower case, a split pattern, then bytes as printable characters.

Nulls and edge cases: a null or empty text has no tokens. Special tokens in a text get their own ids, also
in the middle of a word. Very long texts are encoded whole. Repeated rows give repeated results; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table

VOCABULARY = "word_bpe_49k.json"
#: pieces of text and words that a task remembers, each with their ids (about 100 bytes an entry)
REMEMBERED = 200_000
#: parts the ids of pieces; no id has it
PIECE_END = b"\xff\xff\xff\xff"


def byte_characters() -> list[str]:
    """The printable character of each byte, as byte-level BPE vocabularies write them: printable Latin-1
    bytes stand for themselves, the others take the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    chars = {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [chars[b] for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.special_pattern = regex.compile("(" + "|".join(
            regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        # the ways of the file's regular expressions: \s and \p{..} by Unicode, leftmost alternative first
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                                          if p["type"] == "Split") + r"|\n")
        chars = byte_characters()
        self.char_ids = np.array([vocab[c] for c in chars], np.int64)
        self.end_ids = np.array([vocab[c + suffix] for c in chars], np.int64)
        self.size = max(vocab.values()) + 1
        keys = np.empty(len(model["merges"]), np.int64)
        into = np.empty(len(keys), np.int64)
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            keys[rank] = vocab[a] * self.size + vocab[b]
            into[rank] = vocab[a + b]
        self.ranks = np.argsort(keys, kind="stable")
        self.keys, self.into = keys[self.ranks], into
        self.memory: dict[str, bytes] = {}
        self.word_memory: dict[str, bytes] = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        self.word_memory["\n"] = PIECE_END

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, by binary search over the sorted keys; len(into) where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.into))

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each (not empty) word, by merge rounds over one flat array."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.char_ids[raw]
        word = np.repeat(np.arange(len(words)), lengths)
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.end_ids[raw[ends]]
        none = len(self.into)
        done_symbols, done_word = [], []
        while len(symbols):
            rank = np.full(len(symbols), none, np.int64)
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self._pair_ranks(symbols[inside], symbols[inside + 1])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[starts, len(symbols)])
            best = np.repeat(np.minimum.reduceat(rank, starts), size)
            over = best == none
            if over.any():
                done_symbols.append(symbols[over])
                done_word.append(word[over])
            hit = (rank == best) & ~over
            # of a run of overlapping hits (a a a), every second one merges
            at = np.flatnonzero(hit)
            if len(at):
                fresh = np.r_[True, np.diff(at) > 1]
                first = np.maximum.accumulate(np.where(fresh, at, 0))
                at = at[(at - first) % 2 == 0]
                symbols[at] = self.into[rank[at]]
            keep = ~over
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        all_symbols, all_words = np.concatenate(done_symbols), np.concatenate(done_word)
        order = np.argsort(all_words, kind="stable")
        ids = all_symbols[order].astype("<u4").tobytes()
        cuts = [0, *(4 * np.cumsum(np.bincount(all_words, minlength=len(words)))).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens, after normalisation. White space only parts words, so that
        it need not be made one blank first. A line feed stands for itself."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return self.pattern.findall(lower(text))

    def special_words(self, piece: str) -> list[str]:
        """Words of a piece of text; special tokens stand for themselves."""
        parts = self.special_pattern.split(piece)
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self.words(part))]

    def learn(self, pieces: set[str]) -> None:
        """Puts the ids of pieces of text (without line feeds) into the memory."""
        memory, ids = self.memory, self.word_memory
        if len(memory) + len(pieces) > REMEMBERED:
            memory.clear()
        fresh = [p for p in pieces if p not in memory]
        joined, special = "\n".join(fresh), []
        if self.special_pattern and self.special_pattern.search(joined):
            special = [p for p in fresh if self.special_pattern.search(p)]
            fresh = list(set(fresh) - set(special))
            joined = "\n".join(fresh)
        flat = self.words(joined)
        listed = [self.special_words(p) for p in special]
        if len(ids) + len(flat) > 2 * REMEMBERED:
            ids.clear()
            ids.update((t, np.array([i], "<u4").tobytes()) for t, i in self.special.items())
            ids["\n"] = PIECE_END
        new = list(set(flat).union(*listed) - ids.keys())
        ids.update(zip(new, self.merge_words([w.encode() for w in new]), strict=True))
        if fresh:
            memory.update(zip(fresh, b"".join(map(ids.__getitem__, flat)).split(PIECE_END), strict=True))
        memory.update((p, b"".join([ids[w] for w in ws])) for p, ws in zip(special, listed, strict=True))

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. A line feed or blank ends every
        word and normalises to one blank, so that the pieces between them are encoded one by one."""
        listed = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        pieces = set().union(*listed)
        if not pieces <= self.memory.keys():
            self.learn(pieces)
        memory = self.memory
        return [b"".join([memory[p] for p in ps]) for ps in listed]

    def decode(self, ids: bytes) -> str:
        """Tokens of the ids, special ones included, with a blank between: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


#: fixed values: capital letters of Unicode 16 and their lower case, which Python 3.13 does not know
NEW_CAPITALS = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {
    c: c + 0x20 for c in range(0x10D50, 0x10D66)}


def lower(text: str) -> str:
    """Lower case character by character, without the rule for a sigma at the end of a word."""
    if text.isascii():
        return text.lower()
    text = text.translate(NEW_CAPITALS) if max(text) >= "\u1c89" else text
    return text.lower() if "Σ" not in text else "".join(map(str.lower, text))


_LOADED: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encoded(docs: DataFrame, path: str, batch_chars: int = 1 << 20) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (array of int), decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for ids, texts in _small_batches(batches, batch_chars):
            codes = bpe.encode_batch(texts)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(c) // 4 for c in codes], pa.int64()),
                 pa.array([np.frombuffer(c, "<i4") for c in codes], pa.list_(pa.int32())),
                 pa.array([hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in codes], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")


def digests(docs: DataFrame, path: str, batch_chars: int = 1 << 20) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, without handing the ids to the JVM."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for ids, texts in _small_batches(batches, batch_chars):
            codes = bpe.encode_batch(texts)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(c) // 4 for c in codes], pa.int64()),
                 pa.array([hashlib.sha256(c).hexdigest() for c in codes], pa.string()),
                 pa.array([hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in codes], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _small_batches(batches: Iterator[pa.RecordBatch], batch_chars: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        lo, held, out = 0, 0, []
        for k in range(batch.num_rows):
            text = texts[k].as_py()
            out.append(text)
            held += len(text or "")
            if held >= batch_chars or k == batch.num_rows - 1:
                yield ids.slice(lo, k + 1 - lo), out
                lo, held, out = k + 1, 0, []


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), path or vocabulary_path())
