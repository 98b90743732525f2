"""Min-hash sketches of word sets and titles, made in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Bands and rows of the sketch of contents: a pair at Jaccard J shares a band with probability 1-(1-J**4)**80,
#: 0.994 at 0.5 and 0.9996 at 0.55.
BANDS, ROWS = 80, 4
#: The same for titles: cosine 0.9 of bigrams is about Jaccard 0.82 or more, of which 0.998 share a band.
TITLE_BANDS, TITLE_ROWS = 24, 7
#: Bands of two rows for contents under one hot title: 0.991 at Jaccard 0.35.
WEAK_BANDS, WEAK_ROWS = 36, 2
MIN_WORDS = 30
MASK = (1 << 63) - 1


def _hashes(items, cache: dict) -> np.ndarray:
    if len(cache) > 400_000:
        cache.clear()
    out = np.empty(len(items), dtype=np.uint64)
    for i, w in enumerate(items):
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        out[i] = h
    return out


def _coefficients(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.RandomState(seed)
    draw = lambda: r.randint(0, 1 << 32, n).astype(np.uint64) << np.uint64(32) | r.randint(0, 1 << 32, n).astype(np.uint64)
    return draw() | np.uint64(1), draw()


def minhash(tokens: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of each of len(a) hash orders over the tokens, 32 bits each."""
    return ((tokens[:, None] * a[None, :] + b[None, :]) >> np.uint64(32)).min(axis=0)


def band_keys(mins: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """A 63-bit key of each run of rows values, different by band."""
    k = (np.arange(bands, dtype=np.uint64) + np.uint64(seed * 1000 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(rows):
        k = (k ^ mins[: bands * rows].reshape(bands, rows)[:, j]) * np.uint64(0xFF51AFD7ED558CCD)
        k ^= k >> np.uint64(32)
    return (k & np.uint64(MASK)).astype(np.int64)


def bits(mins: np.ndarray) -> np.ndarray:
    """The lowest bit of each value, 64 in a long."""
    return np.packbits((mins & np.uint64(1)).astype(np.uint8)).view(np.int64)


def word_sets(least: int = MIN_WORDS):
    """(id, title, content) -> (id, title, cls, tokens), without contents of fewer than least words.

    cls is a 128-bit digest of the word set, tokens its sorted 64-bit hashes.
    """

    return lambda batches: _word_sets(batches, least)


def _word_sets(batches, least: int):
    cache: dict = {}
    for batch in batches:
        rows: list = [[], [], [], []]
        for i, t, x in zip(*(batch.column(k).to_pylist() for k in range(3))):
            found = set(x.split()) if x else ()
            if len(found) < least:
                continue
            h = np.sort(_hashes(found, cache))
            for col, v in zip(rows, (i, t or "", xxhash.xxh3_128_digest(h.tobytes()), h.view(np.int64))):
                col.append(v)
        flat = pa.array(np.concatenate(rows[3]) if rows[3] else np.zeros(0, np.int64))
        ends = pa.array(np.cumsum([0, *map(len, rows[3])]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.binary()), pa.ListArray.from_arrays(ends, flat)],
            ["id", "title", "cls", "tokens"],
        )


WORD_SETS = "id long, title string, cls binary, tokens array<long>"


def _lists(rows: list) -> pa.ListArray:
    width = len(rows[0]) if rows else 1
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * width, pa.int32()), pa.array(flat))


def content_bands(bands: int = BANDS):
    """(rep, tokens) -> (rep, n, s0..s3, bands): the set's size, 256 sketch bits and the keys of the bands."""
    return lambda batches: _content_bands(batches, bands)


def _content_bands(batches, bands: int):
    a, b = _coefficients(bands * ROWS, 11)
    for batch in batches:
        sigs, keys = [], []
        tokens = batch.column(1)
        values, ends = tokens.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))])
        for i in range(len(tokens)):
            m = minhash(values[ends[i] : ends[i + 1]], a, b)
            sigs.append(bits(m[:256]))
            keys.append(band_keys(m, bands, ROWS, 1))
        s = np.array(sigs, dtype=np.int64).reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends), pa.int32()), *(pa.array(s[:, j]) for j in range(4)), _lists(keys)], ["rep", "n", "s0", "s1", "s2", "s3", "bands"])


CONTENT_BANDS = "rep long, n int, s0 long, s1 long, s2 long, s3 long, bands array<long>"


def weak_bands(batches):
    """(rep, tokens) -> (rep, bands): keys of bands of WEAK_ROWS rows."""
    a, b = _coefficients(WEAK_BANDS * WEAK_ROWS, 13)
    for batch in batches:
        keys = [band_keys(minhash(np.array(x, np.int64).view(np.uint64), a, b), WEAK_BANDS, WEAK_ROWS, 3) for x in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(keys)], ["rep", "bands"])


WEAK = "rep long, bands array<long>"


def grams(title: str) -> list[str]:
    """Character bigrams without white space; a single character stands for itself."""
    s = "".join(title.split())
    return [s[i : i + 2] for i in range(len(s) - 1)] if len(s) > 1 else [s] if s else []


def title_bands(batches):
    """(tid, title) -> (tid, s0, s1, bands) for titles that aren't blank."""
    a, b = _coefficients(TITLE_BANDS * TITLE_ROWS, 12)
    cache: dict = {}
    for batch in batches:
        ids, sigs, keys = [], [], []
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if g := set(grams(t)):
                m = minhash(_hashes(g, cache), a, b)
                ids.append(i)
                sigs.append(bits(m[:128]))
                keys.append(band_keys(m, TITLE_BANDS, TITLE_ROWS, 2))
        s = np.array(sigs, dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(s[:, 0]), pa.array(s[:, 1]), _lists(keys)], ["tid", "s0", "s1", "bands"])


TITLE_BANDS_SCHEMA = "tid long, s0 long, s1 long, bands array<long>"
