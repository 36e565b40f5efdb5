"""Token counts of fields or sections, from one encoding of the whole document.

A document is encoded once, whole, so its tokens are those a model sees; every token has a span of
the text. Spans of tokens and sections are joined as sorted intervals. A token within one section
counts there. A token that crosses a boundary counts once, for the section that holds most of its
bytes, the earlier one if they hold equally many; a token that touches no section is outside.

Special tokens written in a text are ordinary text. Spans are given in characters (code points); a
character may be several tokens, and each belongs to where its bytes lie.

Defined cases: a null text is empty; an empty text is one empty line without tokens; sections may be
empty (no tokens), may leave gaps, and must be sorted and not overlap; repeated rows are counted each
on its own; an empty table gives an empty result. Other columns are kept by ``count_spans``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.bpe import codec_of, ship, vocabulary_path
from ledgerline.llm.common import ddl, documents, in_slices


def allocate(lengths: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of every token (-1: outside) and whether it crosses a boundary.

    ``lengths`` are the tokens' bytes in order, ``starts`` and ``ends`` the sections' bytes.
    """
    stop = np.cumsum(lengths, dtype=np.int64)
    start = stop - lengths
    full = np.flatnonzero(ends > starts)
    begins, finishes = starts[full], ends[full]
    first = np.searchsorted(finishes, start, "right")
    last = np.searchsorted(begins, stop, "left") - 1
    chosen = np.where(first <= last, first, -1)
    crosses = first < last
    for t in np.flatnonzero(crosses):
        span = np.arange(first[t], last[t] + 1)
        held = np.minimum(finishes[span], stop[t]) - np.maximum(begins[span], start[t])
        chosen[t] = span[np.argmax(held)]
    inside = chosen >= 0
    out = np.full(len(chosen), -1, np.int64)
    out[inside] = full[chosen[inside]]
    return out, crosses


def _byte_places(text: str, data: bytes, places: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets."""
    if len(text) == len(data):
        return places
    begins = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.r_[begins, len(data)][np.clip(places, 0, len(text))]


def _counts(codec, text: str, starts, ends) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens and boundary-crossing tokens of every section, and tokens outside."""
    data = text.encode("utf-8")
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    lengths = codec.token_lengths(text)
    section, crosses = allocate(lengths, _byte_places(text, data, starts), _byte_places(text, data, ends))
    n = len(starts)
    inside = section >= 0
    tokens = np.bincount(section[inside], minlength=n)
    crossing = np.bincount(section[inside & crosses], minlength=n)
    return tokens, crossing, int(np.count_nonzero(~inside))


def count_spans(df: DataFrame, path: str, text: str = "text", spans: str = "spans") -> DataFrame:
    """Adds ``tokens`` and ``crossing`` (one number per span) and ``outside``.

    ``spans`` is an array of structs (start, end) in characters; null counts as no spans.
    """
    file = ship(df.sparkSession, path)
    kept = [c for c in df.columns if c not in ("tokens", "crossing", "outside")]

    def make():
        codec = codec_of(file)

        def work(rows):
            out = {"tokens": [], "crossing": [], "outside": []}
            for t, given in zip(rows[text], rows[spans], strict=True):
                given = given or []
                tokens, crossing, outside = _counts(codec, t or "", [s["start"] for s in given], [s["end"] for s in given])
                out["tokens"].append(tokens.tolist())
                out["crossing"].append(crossing.tolist())
                out["outside"].append(outside)
            return out

        return work

    schema = ddl(df, kept) + ", tokens array<bigint>, crossing array<bigint>, outside bigint"
    return in_slices(df.select(*kept), make, schema, rows=64, use=[text, spans])


def count_fields(df: DataFrame, path: str, fields: list[str], separator: str = "\n", key: str = "doc_id") -> DataFrame:
    """key, field, n_tokens, n_crossing for documents made of several text columns; the document is
    the fields in order with the separator between them, which itself is in no field."""
    texts = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in fields]
    whole = F.concat_ws(separator, *texts).alias("text")
    start, spans = F.lit(0), []
    for t in texts:
        end = start + F.length(t)
        spans.append(F.struct(start.alias("start"), end.alias("end")))
        start = end + len(separator)
    counted = count_spans(df.select(key, whole, F.array(*spans).alias("spans")), path)
    names = F.array(*[F.lit(c) for c in fields])
    each = counted.select(key, F.posexplode(F.arrays_zip("tokens", "crossing")).alias("i", "n"), names.alias("names"))
    return each.select(key, F.element_at("names", F.col("i") + 1).alias("field"), F.col("n.tokens").alias("n_tokens"), F.col("n.crossing").alias("n_crossing"))


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every line in characters; a line holds the line feed that ends it."""
    lengths = np.fromiter((len(x) + 1 for x in text.split("\n")), np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    ends[-1] -= 1
    return starts, ends


def count_lines(docs: DataFrame, path: str) -> DataFrame:
    """A row per line of every document: doc_id, section, start_char, end_char, n_tokens, n_crossing."""
    file = ship(docs.sparkSession, path)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def make():
        codec = codec_of(file)

        def work(rows):
            ids, out = [], {n: [] for n in ("section", "start_char", "end_char", "n_tokens", "n_crossing")}
            for doc, text in zip(rows["doc_id"], rows["text"], strict=True):
                starts, ends = line_spans(text or "")
                tokens, crossing, _ = _counts(codec, text or "", starts, ends)
                ids += [doc] * len(starts)
                for name, values in zip(out, (np.arange(len(starts)), starts, ends, tokens, crossing), strict=True):
                    out[name].append(values)
            return {"doc_id": ids} | {n: np.concatenate(v) for n, v in out.items()}

        return work

    schema = f"doc_id {kind}, section bigint, start_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint"
    return in_slices(docs.select("doc_id", "text"), make, schema, rows=64)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_lines(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"))
