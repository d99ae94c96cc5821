"""BPE encoding and decoding in batched numpy merge rounds.

The vocabulary file names the steps: NFC, white space to one space, lower case, a split into
words, bytes, merges within a word, a mark on the word's last byte. Each distinct word of a batch
of texts is encoded once: the symbols of all new words lie in one flat array, and a round looks
all neighbouring pairs up in the sorted pair keys by binary search, finds the lowest rank of each
word and merges there. A round merges every occurrence of a word's lowest pair from the left, as
long as no merge of the new symbol ranks lower than the pair itself; else the leftmost alone, so
that the order of merges is that of one at a time.

A null text is empty, an empty text has no ids. Texts are encoded whole, at any length. The
strings of special tokens in a text become their ids.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

_FAR = np.int64(1) << 62

#: Words kept from batch to batch, so that a worker's memory is bounded.
CACHE_WORDS = 400_000


def _byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBpe:
    """Encoder and decoder of a vocabulary file of word-end BPE; small enough to be broadcast."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.strings = np.array(self.tokens, dtype=object)
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                            if p["type"] == "Split")
        signs = {b: sign for sign, b in _byte_signs().items()}
        self.inner = np.array([vocab[signs[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[signs[b] + self.suffix] for b in range(256)], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.width = np.int64(len(self.tokens))
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made
        # The lowest rank at which each symbol is merged further, on either side.
        further = np.full(len(self.tokens), _FAR, dtype=np.int64)
        np.minimum.at(further, left, np.arange(len(pairs)))
        np.minimum.at(further, right, np.arange(len(pairs)))
        self.all_at_once = further[made] > np.arange(len(pairs))
        self._cache: dict[str, list[int]] = {}
        self._set_up()

    def _set_up(self) -> None:
        self._split = regex.compile(self.pattern)
        self._special = regex.compile("|".join(
            regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or "(?!)")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_split", "_special")} \
            | {"_cache": {}}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._set_up()

    @classmethod
    def from_file(cls, path: str) -> WordBpe:
        with open(path, encoding="utf-8") as file:
            return cls(file.read())

    # ---- words ------------------------------------------------------------------------------

    def _normal(self, text: str) -> str:
        """NFC and lower case; white space needs no change, as the split drops it anyway."""
        if not text.isascii():
            # Lower case goes sign by sign, so that a final sigma is no exception.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def words(self, text: str) -> list[str | int]:
        """The words of a text; an int is the id of a special token."""
        if not self._special.search(text):
            return self._split.findall(self._normal(text))
        found, at = [], 0
        for m in self._special.finditer(text):
            found += self._split.findall(self._normal(text[at:m.start()]))
            found.append(self.special[m[0]])
            at = m.end()
        return found + self._split.findall(self._normal(text[at:]))

    # ---- merge rounds -----------------------------------------------------------------------

    def merged(self, words: Sequence[str]) -> list[bytes]:
        """The ids of each word as unsigned 32-bit integers, all words merged side by side."""
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], dtype=np.int64)
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        symbols, ends = self.inner[flat], np.cumsum(sizes)
        symbols[ends - 1] = self.last[flat[ends - 1]]
        word = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_words = [], []
        while len(symbols):
            key = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.ranks[at], _FAR)
            rank = np.append(rank, _FAR)
            heads = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            counts = np.diff(np.append(heads, len(word)))
            lowest = np.minimum.reduceat(rank, heads)
            active = np.repeat(lowest < _FAR, counts)
            if not active.all():
                # Words without a pair to merge are done and leave the array.
                done_symbols.append(symbols[~active])
                done_words.append(word[~active])
                symbols, word, rank = symbols[active], word[active], rank[active]
                lowest, counts = lowest[lowest < _FAR], counts[lowest < _FAR]
                if not len(symbols):
                    break
                heads = np.cumsum(counts) - counts
            best = np.repeat(lowest, counts)
            hits = np.flatnonzero(rank == best)
            # Of hits that overlap, every other one counted from the left of their run.
            run = np.concatenate(([True], np.diff(hits) != 1))
            index = np.arange(len(hits))
            hits = hits[(index - np.maximum.accumulate(np.where(run, index, 0))) % 2 == 0]
            first = np.concatenate(([True], word[hits[1:]] != word[hits[:-1]]))
            hits = hits[first | self.all_at_once[best[hits]]]
            symbols[hits] = self.made[best[hits]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[hits + 1] = False
            symbols, word = symbols[keep], word[keep]
        if done_symbols:
            symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        ids = symbols[order].astype("<u4").tobytes()
        stops = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [ids[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    # ---- texts ------------------------------------------------------------------------------

    def encode_batch(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The ids of each text, as unsigned 32-bit integers."""
        split = [self.words(text) if text else [] for text in texts]
        known, wanted = self._cache, set(chain.from_iterable(split))
        new = wanted - known.keys()
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = wanted
        for w in [w for w in new if isinstance(w, int)]:
            known[w] = w.to_bytes(4, "little")
            new.discard(w)
        fresh = list(new)
        if fresh:
            known.update(zip(fresh, self.merged(fresh), strict=True))
        return [np.frombuffer(b"".join([known[w] for w in words]), dtype="<u4") for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """The tokens' strings with spaces between, as the file's (absent) decoder leaves them."""
        return " ".join(self.strings[ids].tolist())


#: Texts encoded at once, in characters.
_CHUNK = 1 << 20


def _parts(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or "")
        if size > _CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def encoded(documents: DataFrame, tokenizer: WordBpe, key: str = "doc_id",
            text: str = "text", function=None, schema: str = "ids array<int>") -> DataFrame:
    """The key and the ids of each text; or what ``function(ids)`` makes of them, by ``schema``.

    One pass over the texts without a shuffle. The tokenizer is broadcast: a vocabulary file has
    a fixed size.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    shared = documents.sparkSession.sparkContext.broadcast(tokenizer)
    rows = documents.select(key, text)
    fields = _parse_datatype_string(schema)
    out = StructType([rows.schema[0], *fields.fields])
    arrow = to_arrow_schema(out)

    def run(batches):
        coder = shared.value
        for batch in batches:
            start = 0
            for part in _parts(batch.column(1).to_pylist()):
                ids = coder.encode_batch(part)
                made = [(x,) for x in ids] if function is None else [function(coder, x) for x in ids]
                keys = batch.column(0).slice(start, len(part))
                start += len(part)
                columns = [pa.array([m[i] for m in made], type=f.type)
                           for i, f in enumerate(list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays([keys.cast(arrow.field(0).type), *columns],
                                                 schema=arrow)

    return rows.mapInArrow(run, out)


def decoded(tokens: DataFrame, tokenizer: WordBpe, key: str = "doc_id",
            ids: str = "ids") -> DataFrame:
    """The key and the decoded text of each list of ids; null lists are empty."""
    from pyspark.sql.types import StringType, StructField, StructType

    shared = tokens.sparkSession.sparkContext.broadcast(tokenizer)
    rows = tokens.select(key, ids)

    def run(batches):
        coder = shared.value
        for batch in batches:
            texts = [coder.decode(np.array(x or [], dtype="<u4"))
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=[key, "text"])

    return rows.mapInArrow(run, StructType([rows.schema[0], StructField("text", StringType())]))
