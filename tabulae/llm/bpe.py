"""BPE encoding and decoding with a public vocabulary file.

A text is cut at the special tokens, brought to NFC, lower-cased character by character and
split into words, digits and runs of other signs; white space goes.  A word's bytes become
symbols, the last with the end mark.  A priority queue holds the ranks of the merges between
neighbours in a doubly linked symbol list; an entry whose symbols have changed meanwhile is
stale and skipped.  Decoding joins the vocabulary strings.

The vocabulary is read on the driver from a path that is a parameter (``MAX_VOCABULARY``
bytes at most) and broadcast.  A worker keeps the encodings of the words that it has met,
``CACHED_WORDS`` at most; the bound changes speed, never results.
"""
from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae.llm.common import built, ship, structs

MAX_VOCABULARY = 64 << 20
CACHED_WORDS = 120_000
#: Letters and numbers that Unicode 17 adds.  Tokenizer tables end with Unicode 16 and see other signs.
_UNICODE_17 = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    "\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    "\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    "\U0003d000-\U0003fc3f")
#: Small letters of the capitals that Unicode 16 and 17 add and this Python may not know yet.
_LATE_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
               0xA7DA: 0xA7DB, 0xA7DC: 0x19B, **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
               **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_WORDS = regex.compile(rf"(?V1){_ENDINGS}|[\p{{L}}--[{_UNICODE_17}]]+|[\p{{N}}--[{_UNICODE_17}]]|"
                       rf"(?:[^\s\p{{L}}\p{{N}}]|[{_UNICODE_17}])+")
#: The same for a lower-cased text of Latin-1 characters, by the faster module.
_LATIN_WORDS = re.compile(rf"{_ENDINGS}|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|(?:[^\sa-zªµºß-öø-ÿ0-9²³¹¼-¾]|[\x1c-\x1f])+")
_DIGEST = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where it is printable in Latin-1, else one from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file (JSON of a BPE model with an end mark of words)."""

    def __init__(self, content: str, cached_words: int | None = None):
        self.most = cached_words or CACHED_WORDS
        spec = json.loads(content)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        ranks: dict[int, int] = {}  # by left id << 20 | right id
        self.made: list[int] = []  # the id that a merge makes, by rank
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks[self.ids[a] << 20 | self.ids[b]] = rank
            self.made.append(self.ids[a + b])
        self.rank_of = ranks.get
        letters = byte_letters()
        self.inner = [self.ids[c] for c in letters]
        self.last = [self.ids[c + self.end] for c in letters]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words: dict[str, tuple[bytes, str, str]] = {}
        self.older: dict[str, tuple[bytes, str, str]] = {}  # the words before these: two generations

    def merge(self, word: str) -> list[int]:
        """Token ids of one word."""
        blob = word.encode("utf-8")
        inner, rank_of, made = self.inner, self.rank_of, self.made
        symbols = [inner[b] for b in blob]
        symbols[-1] = self.last[blob[-1]]
        n = len(symbols)
        # rank of the merge of a place's symbol with its right neighbour; a queue entry is rank * n + place
        current = [rank_of(a << 20 | b, -1) for a, b in zip(symbols, symbols[1:])]
        queue = [r * n + i for i, r in enumerate(current) if r >= 0]
        if not queue:
            return symbols
        current.append(-1)
        heapify(queue)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            rank, i = divmod(heappop(queue), n)
            if current[i] != rank:
                continue  # stale: one of the two has merged since
            j = after[i]
            symbols[i], symbols[j] = new, _ = made[rank], -1
            current[i] = current[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(new << 20 | symbols[k], -1)) >= 0:
                    current[i] = r
                    heappush(queue, r * n + i)
            if (h := before[i]) >= 0:
                current[h] = r = rank_of(symbols[h] << 20 | new, -1)
                if r >= 0:
                    heappush(queue, r * n + h)
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> tuple[bytes, str, str]:
        """A word's ids (4 bytes each), their decimal numbers and their strings, both joined by spaces."""
        found = self.older.get(word)
        if found is None:
            ids = self.merge(word)
            strings = self.strings
            found = (array("i", ids).tobytes(), " ".join(map(str, ids)), " ".join([strings[i] for i in ids]))
        if len(self.words) >= self.most:
            self.words, self.older = {}, self.words
        self.words[word] = found
        return found

    def pieces(self, text: str) -> list[tuple[bytes, str, str]]:
        """The words of a text in order, each with its ids, numbers and strings."""
        out = []
        at = 0
        if self.cut and any(s in text for s in self.special):
            for m in self.cut.finditer(text):
                out += self._plain(text[at:m.start()])
                i = self.special[m.group()]
                out.append((array("i", [i]).tobytes(), str(i), m.group()))
                at = m.end()
        out += self._plain(text[at:] if at else text)
        return out

    def _plain(self, text: str) -> list[tuple[bytes, str, str]]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            # character by character: a whole text would turn a final capital sigma into another letter
            text = "".join([c.lower() for c in text]) if "Σ" in text else text.lower()
            if max(text) > "ÿ":
                words, make = self.words, self.word
                return [words.get(w) or make(w) for w in _WORDS.findall(text.translate(_LATE_LOWER))]
        else:
            text = text.lower()
        words, make = self.words, self.word
        return [words.get(w) or make(w) for w in _LATIN_WORDS.findall(text)]

    def encode(self, text: str) -> list[int]:
        return array("i", b"".join([p[0] for p in self.pieces(text)])).tolist()

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings, special ones too, joined by single spaces; unknown ids are left out."""
        return " ".join([self.strings[i] for i in ids if i in self.strings])


def load(spark: SparkSession, path: str):
    """The vocabulary file's content as a broadcast, after a check of its size."""
    if os.path.getsize(path) > MAX_VOCABULARY:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY} bytes")
    ship(spark)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(spark: SparkSession, text: Column, path: str) -> Column:
    """Token ids of a text; null counts as the empty text and has none."""
    block = load(spark, path)

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        codec = built(block, Codec)
        return pa.array([codec.encode(t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))

    return run(text)


def decode(spark: SparkSession, ids: Column, path: str) -> Column:
    """The text of token ids; null has the empty text."""
    block = load(spark, path)

    @F.arrow_udf("string")
    def run(rows: pa.Array) -> pa.Array:
        codec = built(block, Codec)
        return pa.array([codec.decode(r or []) for r in rows.to_pylist()], pa.string())

    return run(ids)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_tokens``, and SHA-256 of the ids (decimal, joined by one space)
    and of the decoded text.  Ids and decoded texts stay in the worker: one pass, no shuffle.

    Null and empty texts have no token; other columns are not read; repeated rows are encoded alike.
    """
    block = load(docs.sparkSession, path)

    @F.arrow_udf("struct<n_tokens long, ids_sha256 string, decoded_sha256 string>")
    def run(texts: pa.Array) -> pa.Array:
        codec = built(block, Codec)
        out: dict[str, list] = {k: [] for k in _DIGEST}
        for text in texts.to_pylist():
            pieces = codec.pieces(text or "")
            out["n_tokens"].append(sum([len(p[0]) for p in pieces]) // 4)
            out["ids_sha256"].append(hashlib.sha256(" ".join([p[1] for p in pieces]).encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(" ".join([p[2] for p in pieces]).encode()).hexdigest())
        return structs(_DIGEST, out)

    return (docs.select(F.col(f"`{id_col}`").alias(id_col), run(F.col(f"`{text_col}`")).alias("digest"))
            .select(id_col, "digest.*"))


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
              cached_words: int | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_tokens``, ``ids`` and ``decoded_sha256``, as in ``round_trip``.

    A worker keeps fewer words than for ``round_trip``, as it holds a batch's ids too.
    """
    block = load(docs.sparkSession, path)

    def codec_of(content: str) -> Codec:
        return Codec(content, cached_words or CACHED_WORDS // 2)

    @F.arrow_udf("struct<ids array<int>, decoded_sha256 string>")
    def run(texts: pa.Array) -> pa.Array:
        codec = built(block, codec_of)
        ids, digests = [], []
        for text in texts:
            pieces = codec.pieces(text.as_py() or "")
            ids.append(b"".join([p[0] for p in pieces]))
            digests.append(hashlib.sha256(" ".join([p[2] for p in pieces]).encode()).hexdigest())
        offsets = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), dtype=np.int32)))
        return pa.StructArray.from_arrays([lists, pa.array(digests, pa.string())], names=["ids", "decoded_sha256"])

    out = docs.select(F.col(f"`{id_col}`").alias(id_col), run(F.col(f"`{text_col}`")).alias("t"))
    return out.select(id_col, F.size("t.ids").cast("long").alias("n_tokens"), "t.ids", "t.decoded_sha256")
