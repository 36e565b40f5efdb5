"""Byte-pair encoding and decoding with the vocabulary file of a public tokenizer.

A text is split at special tokens, normalised, cut into words by the file's pattern, and every word
becomes a doubly linked list of symbols. A priority queue holds the rank of each adjacent pair; the
lowest rank is merged first, entries that no longer describe two living neighbours are skipped.
Decoding looks the ids up and concatenates their vocabulary strings, by the file's decoder: none
joins them by a space, byte level turns them back into bytes.

Defined cases: a null text is empty and has no tokens; nulls in other columns pass; repeated rows
are encoded each on its own; an empty table gives an empty result. Result columns that the input
already has are replaced.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import Remember, ddl, documents, in_slices


#: The word pattern of word_bpe_49k.json: no alternative matches white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Distinct chunks a worker remembers in each of two generations, some 60 MB together; they stay from
#: task to task, beside whatever the worker does next.
CACHE_CHUNKS = 150_000

#: Symbols up to which a word is merged without a queue.
SHORT_WORD = 32

_MARKS = frozenset(".,:;!?")

#: Separators that str.split() takes for white space and the pattern does not.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")


#: White space that is not a single space or line feed between two other characters.
_UNEVEN_SPACE = regex.compile(r"[^\S \n]|[\x1c-\x1f]|\s\s")
_UNEVEN_ASCII = ("  ", "\n ", " \n", "\n\n", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f")


def _has_uneven_space(text: str) -> bool:
    if text.isascii():  # a look for each of these is quicker than one for the pattern
        return any(s in text for s in _UNEVEN_ASCII)
    return _UNEVEN_SPACE.search(text) is not None


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer lies; read on the driver alone, executors get the content."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 stays, the rest follows from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    letters |= {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def _merge_short(symbols: list[int], ranks: dict[int, int], merges: list[tuple[int, int, int]], size: int) -> list[int]:
    """``merge_symbols`` for few symbols, where a look at all ranks is quicker than a queue of them."""
    none, rank_of = len(merges), ranks.get
    found = [rank_of(a * size + b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
    found.append(none)  # after the last symbol
    lowest = min(found)
    if lowest == none:
        return symbols
    symbols = symbols[:]
    while lowest < none:
        i = found.index(lowest)
        new = symbols[i] = merges[lowest][2]
        del symbols[i + 1], found[i]
        if i + 1 < len(symbols):
            found[i] = rank_of(new * size + symbols[i + 1], none)
        if i:
            found[i - 1] = rank_of(symbols[i - 1] * size + new, none)
        lowest = min(found)
    return symbols


def merge_symbols(symbols: list[int], ranks: dict[int, int], merges: list[tuple[int, int, int]], size: int) -> list[int]:
    """Merge the pair of lowest rank, leftmost first, until no neighbours have a rank.

    ``ranks`` has the rank of left * size + right, ``merges`` left, right and result of each rank.
    """
    if len(symbols) <= SHORT_WORD:
        return _merge_short(symbols, ranks, merges, size)
    n, rank_of = len(symbols), ranks.get
    found = [rank_of(a * size + b) for a, b in zip(symbols, symbols[1:], strict=False)]
    queue = [rank * n + i for i, rank in enumerate(found) if rank is not None]  # place of the left symbol
    if not queue:
        return symbols
    symbols = symbols[:]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heapify(queue)
    while queue:
        rank, i = divmod(heappop(queue), n)
        left, right, new = merges[rank]
        j = after[i]
        if symbols[i] != left or j == n or symbols[j] != right:
            continue  # stale: one of the two has been merged since
        symbols[i], symbols[j] = new, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = rank_of(new * size + symbols[k])
            if rank is not None:
                heappush(queue, rank * n + i)
        h = before[i]
        if h >= 0:
            rank = rank_of(symbols[h] * size + new)
            if rank is not None:
                heappush(queue, rank * n + h)
    return [s for s in symbols if s >= 0]


class Codec:
    """Encoder and decoder of one vocabulary file (BPE model over byte-level letters)."""

    def __init__(self, file: str):
        self._read(json.loads(file))
        self._words = Remember(self._encode_word)
        self._chunks = Remember(self._encode_chunk, CACHE_CHUNKS)
        self._sizes = Remember(self._sizes_of, CACHE_CHUNKS)

    def _read(self, given: dict) -> None:
        model = given["model"]
        unknown = [model.get(k) for k in ("unk_token", "continuing_subword_prefix", "dropout")]
        if model["type"] != "BPE" or any(unknown):
            raise ValueError("only plain BPE files are read")
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self._inner = [vocab.get(c, -1) for c in letters]
        self._last = [vocab.get(c + suffix, -1) for c in letters]
        size = self._size = max([*vocab.values(), *(t["id"] for t in given["added_tokens"])]) + 1
        self._merges, self._ranks = [], {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self._merges.append((vocab[a], vocab[b], vocab[a + b]))
            self._ranks.setdefault(vocab[a] * size + vocab[b], rank)
        self._strings = [""] * size
        for string, i in vocab.items():
            self._strings[i] = string
        self._special = {}
        for t in given["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]:
                raise ValueError("only plain added tokens are read")
            self._special[t["content"]] = t["id"]
            self._strings[t["id"]] = t["content"]
        self._lengths = [len(string) for string in self._strings]
        special = sorted(self._special, key=len, reverse=True)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._normal = [self._normaliser(n) for n in self._sequence(given.get("normalizer"), "normalizers")]
        self._find = self._pattern(self._sequence(given.get("pre_tokenizer"), "pretokenizers"))
        self._drops_space = self._find.pattern == WORD_PATTERN
        decoder = given.get("decoder")
        if decoder and decoder["type"] != "ByteLevel":
            raise ValueError("only the byte-level decoder or none")
        self._bytes = {c: b for b, c in enumerate(letters)} if decoder else None

    @staticmethod
    def _sequence(step: dict | None, name: str) -> list[dict]:
        return [] if not step else step[name] if step["type"] == "Sequence" else [step]

    @staticmethod
    def _normaliser(step: dict) -> Callable[[str], str]:
        if step["type"] == "NFC":
            return lambda s: s if s.isascii() else unicodedata.normalize("NFC", s)
        if step["type"] == "Lowercase":
            # Letter by letter: a final sigma has no form of its own here.
            return lambda s: "".join(map(str.lower, s)) if "Σ" in s else s.lower()
        if step["type"] == "Replace":
            found, new = regex.compile(step["pattern"]["Regex"]), step["content"]
            return lambda s: found.sub(lambda _: new, s)
        raise ValueError(f"normaliser {step['type']}")

    @staticmethod
    def _pattern(steps: list[dict]) -> regex.Pattern:
        from public_tokenizers import PATTERN

        kinds = [s["type"] for s in steps]
        if kinds == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]:
            return regex.compile(steps[0]["pattern"]["Regex"])  # what lies between matches is dropped
        if kinds == ["ByteLevel"] and not steps[0]["add_prefix_space"]:
            return regex.compile(PATTERN)
        raise ValueError(f"pre-tokenizer {kinds}")

    def _ids_of(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        symbols = [self._inner[b] for b in data[:-1]] + [self._last[data[-1]]]
        return merge_symbols(symbols, self._ranks, self._merges, self._size)

    def _encode_word(self, word: str) -> bytes:
        return np.array(self._ids_of(word), "<u4").tobytes()

    def pieces(self, text: str) -> list[str]:
        """The words of a text without special tokens, as the pattern finds them."""
        for step in self._normal:
            text = step(text)
        return self._find.findall(text)

    def word_ids(self, word: str) -> bytes:
        return self._words[word]

    def _encode_chunk(self, chunk: str) -> bytes:
        if chunk.isalpha():  # a run of letters is one word
            return self._encode_word(chunk)
        if chunk[-1] in _MARKS and chunk[:-1].isalpha():
            return self._chunks[chunk[:-1]] + self._words[chunk[-1]]
        return self._encode_words(chunk)

    def _encode_words(self, text: str) -> bytes:
        return b"".join(map(self._words.__getitem__, self._find.findall(text)))

    def _encode_part(self, text: str) -> bytes:
        for step in self._normal:
            text = step(text)
        if self._drops_space and not _ODD_SPACE.search(text):
            # No match of the pattern holds or sees white space, so what stands between is cut alone.
            return b"".join(map(self._chunks.__getitem__, text.split()))
        return self._encode_words(text)

    def _sizes_of(self, chunk: str) -> bytes:
        word = chunk[1:] if chunk[0] == " " else chunk
        if not word.isalpha():  # a run of letters is one piece
            if word[-1:] in _MARKS and word[:-1].isalpha():
                return self._sizes[chunk[:-1]] + self._sizes[chunk[-1]]
            pieces = self._find.findall(chunk)
            if len(pieces) > 1:
                return b"".join(map(self._sizes.__getitem__, pieces))
        return bytes(map(self._lengths.__getitem__, self._ids_of(chunk)))

    def token_lengths(self, text: str) -> np.ndarray:
        """Bytes of every token of a text, special tokens taken as ordinary text. Only for files that
        leave the text as it is, so that lengths add up to places in it."""
        if self._normal or self._drops_space:
            raise ValueError("tokens of this file have no places in the text")
        sizes = self._sizes.__getitem__
        if _has_uneven_space(text):
            return np.frombuffer(b"".join(map(sizes, self._find.findall(text))), np.uint8)
        # Single spaces and line feeds: a space belongs to the word after it, a line feed stands alone.
        out = []
        for i, line in enumerate(text.split("\n")):
            if i:
                out.append(sizes("\n"))
            if line:
                # A space before the first word of a text leaves an empty chunk in front.
                out += map(sizes, filter(None, line.replace(" ", "\n ").split("\n")))
        return np.frombuffer(b"".join(out), np.uint8)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out = []
        for part in self._cut.split(text) if self._cut else (text,):
            if part in self._special:
                out.append(self._special[part].to_bytes(4, "little"))
            elif part:
                out.append(self._encode_part(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        strings = map(self._strings.__getitem__, np.frombuffer(ids, "<u4").tolist())
        if self._bytes is None:
            return " ".join(strings)
        return bytes(map(self._bytes.__getitem__, "".join(strings))).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec_of(file: Broadcast) -> Codec:
    """The codec of a broadcast file, built once per Python worker."""
    given = file.value
    if given not in _CODECS:
        _CODECS.clear()
        _CODECS[given] = Codec(given)
    return _CODECS[given]


def ship(spark: SparkSession, path: str) -> Broadcast:
    """A vocabulary file for all executors; its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _keep(df: DataFrame, column: str, new: list[str]) -> tuple[DataFrame, list[str]]:
    """The columns that stay, and the one to work on as __given."""
    kept = [c for c in df.columns if c not in new]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias("__given")), kept


def encode(df: DataFrame, path: str, text: str = "text", digests: bool = False) -> DataFrame:
    """Adds ``n_tokens`` and ``ids``; with ``digests`` also the hashes of the ids and of what they
    decode to, so that a round trip over all rows needs one pass."""
    new = ["n_tokens", "ids"] + ["ids_sha256", "decoded_sha256"] * digests
    narrowed, kept = _keep(df, text, new)
    file = ship(df.sparkSession, path)
    schema = f"{ddl(df, kept)}, n_tokens bigint, ids array<int>"
    schema += ", ids_sha256 string, decoded_sha256 string" * digests

    def make():
        codec = codec_of(file)

        def work(rows):
            packed = [codec.encode(t) for t in rows["__given"]]
            out = {
                "n_tokens": [len(p) // 4 for p in packed],
                "ids": [np.frombuffer(p, "<i4") for p in packed],
            }
            return out | _digests(codec, packed) if digests else out

        return work

    return in_slices(narrowed, make, schema, rows=64, use=["__given"])


def _digests(codec: Codec, packed: list[bytes]) -> dict[str, list[str]]:
    return {
        "ids_sha256": [hashlib.sha256(p).hexdigest() for p in packed],
        "decoded_sha256": [hashlib.sha256(codec.decode(p).encode("utf-8")).hexdigest() for p in packed],
    }


def decode(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the text of the column of ids; null ids decode to the empty text."""
    narrowed, kept = _keep(df, ids, ["decoded"])
    file = ship(df.sparkSession, path)

    def make():
        codec = codec_of(file)

        def work(rows):
            given = rows["__given"]
            return {"decoded": [codec.decode(np.array(i or [], "<u4").tobytes()) for i in given]}

        return work

    return in_slices(narrowed, make, f"{ddl(df, kept)}, decoded string", rows=64, use=["__given"])


def round_trip(df: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Per row: key, number of tokens, and the digests of the ids and of the text they decode to."""
    file = ship(df.sparkSession, path)
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def make():
        codec = codec_of(file)

        def work(rows):
            packed = [codec.encode(t) for t in rows["text"]]
            return {key: rows[key], "n_tokens": [len(p) // 4 for p in packed]} | _digests(codec, packed)

        return work

    return in_slices(df.select(key, "text"), make, schema, rows=64)


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))
