"""Encoding a corpus with a public byte-level tokenizer.

Long texts are cut into overlapping chunks, which are pre-tokenised apart, in different tasks. Where, inside the
overlap, both sides set a boundary at the same place, the later one's pieces take over: the pattern looks only
ahead, so from a common boundary both go on alike. If an overlap holds no common boundary, the two chunks are joined
and pre-tokenised again. The pieces are then encoded each by itself, and a text's ids are those of its pieces in
order. Decoding concatenates the bytes of the ids.

An empty text has an empty list of ids, and so has a null text.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokeniser's pattern, as the tokenizer's files give it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of a chunk and of the overlap with the next.
CHUNK, OVERLAP = 1 << 11, 1 << 8


def vocabulary(path: str = VOCABULARY) -> bytes:
    """The file's bytes (under 1 MB); they travel with the tasks, so executors need no copy."""
    with open(path, "rb") as f:
        return f.read()


def encoding(raw: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x)}
    return tiktoken.Encoding("cribble", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_made: dict = {}


def _encoder(raw: bytes):
    key = hash(raw)
    if key not in _made:
        _made[key] = encoding(raw)
    return _made[key]


def boundaries(text: str, start: int = 0) -> list[int]:
    """Ends of the pre-tokens of text, counted from start."""
    import regex

    return [start + m.end() for m in regex.finditer(PATTERN, text)]


def chunk_bounds(n: int, size: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(start, end) of the overlapping chunks of a text of n characters."""
    if n <= size:
        return [(0, n)]
    step = size - overlap
    return [(i, min(n, i + size)) for i in range(0, max(1, n - overlap), step)]


def stitch(chunks: list[tuple[int, str, list[int]]]) -> list[str]:
    """Texts between resynchronised boundaries that cover the whole text. chunks: (start, text, boundaries), in order.

    Each returned text begins and ends at a pre-token boundary of the whole text.
    """
    out: list[str] = []
    at, text, ends = chunks[0]
    begin = at
    for nxt, more, cuts in chunks[1:]:
        # the last boundary of a chunk may come from its end alone, and its last pre-tokens from what it doesn't see
        stop = at + len(text)
        common = sorted(x for x in set(ends) & set(cuts) if nxt < x < stop)
        common = common[: max(0, len(common) - 2)] if nxt + len(more) > stop else common
        # white space before a boundary is split by what follows it, which a piece that ends there wouldn't see
        common = [x for x in common if not text[x - 1 - at].isspace()]
        if common:
            s = common[len(common) // 2]
            out.append(text[begin - at : s - at])
            at, text, ends, begin = nxt, more, cuts, s
        else:
            text = text[: nxt - at] + more
            ends = boundaries(text[begin - at :], begin)
    out.append(text[begin - at :])
    return [x for x in out if x]


def encode_chunked(text: str, enc, size: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """The ids of a text by way of chunks."""
    parts = [(a, text[a:b], boundaries(text[a:b], a)) for a, b in chunk_bounds(len(text), size, overlap)]
    return [i for piece in stitch(parts) for i in enc.encode_ordinary(piece)]


def encode_short(raw: bytes, count: bool = False):
    """(id, text, ...) -> (id, ids), or with count (id, further columns, tokens)."""

    def run(batches):
        enc = _encoder(raw)
        for batch in batches:
            ids = [enc.encode_ordinary(x) if x else [] for x in batch.column(1).to_pylist()]
            if count:
                more = list(range(2, batch.num_columns))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(batch.column(k) for k in more), pa.array([len(x) for x in ids], pa.int64())], ["id", *(batch.schema.names[k] for k in more), "tokens"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    return run


def _cut(size: int, overlap: int):
    def run(batches):
        for batch in batches:
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = chunk_bounds(len(x), size, overlap)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(b), pa.int64()), pa.array([s for s, _ in b], pa.int64()), pa.array([x[s:e] for s, e in b], pa.string())], ["id", "start", "text"])

    return run


def _bound():
    def run(batches):
        for batch in batches:
            starts, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([boundaries(x, s) for s, x in zip(starts, texts)], pa.list_(pa.int64()))], ["id", "start", "text", "ends"])

    return run


def _stitched(raw: bytes, count: bool = False):
    """(id, chunks) -> (id, ids), or with count (id, tokens): the chunks of one text per row."""

    def run(batches):
        enc = _encoder(raw)
        for batch in batches:
            out = []
            for chunks in batch.column(1).to_pylist():
                chunks.sort(key=lambda r: r["start"])
                out.append([i for piece in stitch([(r["start"], r["text"], r["ends"]) for r in chunks]) for i in enc.encode_ordinary(piece)])
            got = pa.array([len(x) for x in out], pa.int64()) if count else pa.array(out, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), got], ["id", "tokens" if count else "ids"])

    return run


def chunked(docs: DataFrame, size: int, overlap: int) -> DataFrame:
    """(id, chunks) of docs (id, text): chunks pre-tokenised apart, in different tasks."""
    parts = docs.mapInArrow(_cut(size, overlap), "id long, start long, text string").repartition("id", "start")
    parts = parts.mapInArrow(_bound(), "id long, start long, text string, ends array<long>")
    # one text is one value of one row in the end
    return parts.groupBy("id").agg(F.collect_list(F.struct("start", "text", "ends")).alias("chunks"))


def encode(docs: DataFrame, path: str = VOCABULARY, size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, ids) of docs (id, text). Texts of up to size characters are encoded where they lie, without a shuffle."""
    raw = vocabulary(path)
    d = docs.select(F.col("id").cast("long").alias("id"), "text")
    short = d.where(f"text is null or length(text) <= {size}").mapInArrow(encode_short(raw), "id long, ids array<int>")
    long = chunked(d.where(f"length(text) > {size}"), size, overlap).mapInArrow(_stitched(raw), "id long, ids array<int>")
    return short.unionByName(long)


def token_counts(docs: DataFrame, path: str = VOCABULARY, extra: tuple[str, ...] = (), size: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(id, extra, tokens) of docs (id, text), ids unique; extra are string columns to carry along."""
    raw = vocabulary(path)
    d = docs.select(F.col("id").cast("long").alias("id"), "text", *extra)
    short = d.where(f"text is null or length(text) <= {size}").mapInArrow(encode_short(raw, True), f"id long, {''.join(f'{c} string, ' for c in extra)}tokens long")
    over = d.where(f"length(text) > {size}")
    long = chunked(over.select("id", "text"), size, overlap).mapInArrow(_stitched(raw, True), "id long, tokens long")
    return short.unionByName(over.select("id", *extra).join(long, "id").select("id", *extra, "tokens"))


def decode(ids: list[int], enc) -> str:
    """The text of ids: their bytes, concatenated, as UTF-8."""
    return b"".join(enc.decode_single_token_bytes(i) for i in ids).decode("utf-8", "replace")
