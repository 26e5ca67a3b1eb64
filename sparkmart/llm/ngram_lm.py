"""Language-model scoring with an Elias-Fano n-gram trie (operator 10).

Tokens are the words of the text, A-Z in lower case, then one end. The model
has three levels, built by Spark from all training texts and cut into shards:

* words: the sorted 64-bit word hashes (Elias-Fano), each with its count; a
  word's id is its rank;
* pairs: for each context word its followers, as one monotone sequence
  ``context's place * (V + 1) + follower's id`` (Elias-Fano) beside the monotone
  contexts and pointers to their first followers (both Elias-Fano); per pair the
  quantised log10 probability and the quantised share that it leaves to its
  shorter context;
* triples: for each pair of the same shard, by its place, a pointer to its first
  follower, and the followers as ``pair's place * (V + 1) + follower's id``
  (Elias-Fano) with their quantised log10 probability. A lookup reads the
  pair's two pointers and searches between them.

p(w) = (c(w) + 1) / (N + V + 1), p(w | u) = (c(u w) + mu p(w)) / (c(u) + mu) and
p(w | t u) = (c(t u w) + mu3 p(w | u)) / (c(t u) + mu3), up to the quantisation (c(t u) is
read back from its quantised form): proper distributions. An n-gram that was not
seen needs its context's share only. The first word's context is the start of the
text; unknown contexts fall back to the shorter one. Everything is counted over
all training texts, nothing is pruned.

Counting: map tasks combine the n-grams of their slice into sorted blocks per
shard (delta coded), which are shuffled and merged per shard. Words are dealt
by hash range; contexts by hash, and a context is split by ranges of its
followers into as many parts as its count asks for: a pair's parts lie in files
of their own. A triple is counted as (its pair's place, follower) and brings
the quantised p(w | u), so a shard is finished without reading another one.
Shards are files in the shared folder that workers memory-map; a lost executor
loses no model.

Cases: null and empty texts are one end token; without training texts N and V
are 0; repeated rows count as often as given; null ids are training rows;
extra columns are not read.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import elias_fano
from sparkmart.llm.common import grouped, mix64, shared_folder, word_hashes

END = np.uint64(0x0123456789ABCDEF)     # hash of the end token
SLICE = 12 << 20                        # bytes of text that are counted or scored at a time
SPLIT = 1 << 18                         # followers of a context that are kept together, about
QUANTUM = 2048                          # steps per decade of the quantised log10 probabilities
PARTS = 1 << 12                         # files of a shard's triples, at most
_U = np.uint64
_COUNT = _U((1 << 48) - 1)              # a block's numbers: the count, above it 16 bits that belong to the code


# --- files in the shared folder

def _local(uri: str) -> str | None:
    p = urlparse(uri)
    return p.path if p.scheme == "file" else uri if not p.scheme else None


def write_file(uri: str, data: bytes) -> None:
    """Written beside its place and renamed, so a repeated task does no harm."""
    path = _local(uri)
    if path is None:
        from pyarrow import fs
        store, path = fs.FileSystem.from_uri(uri)
        store.create_dir(os.path.dirname(path))
        with store.open_output_stream(path) as f:
            f.write(data)
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with tempfile.NamedTemporaryFile(dir=os.path.dirname(path), delete=False) as f:
        f.write(data)
    os.replace(f.name, path)


def map_file(uri: str) -> np.ndarray:
    """The file's words, memory-mapped (of a remote folder: read into memory)."""
    path = _local(uri)
    if path is None:
        from pyarrow import fs
        store, path = fs.FileSystem.from_uri(uri)
        with store.open_input_stream(path) as f:
            return np.frombuffer(f.read(), np.uint64)
    return np.memmap(path, np.uint64, "r")


def _pad(b: bytes) -> bytes:
    return b + bytes(-len(b) % 8)


# --- tokens

def token_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens (ends included) and the number of tokens per text."""
    h, n = word_hashes([(t or "").encode().lower() for t in texts])   # bytes.lower() changes A-Z only
    at = np.cumsum(n + 1) - 1
    out = np.empty(len(h) + len(n), np.uint64)
    word = np.ones(len(out), bool)
    word[at] = False
    out[word] = h
    out[at] = END
    return out, n + 1


# --- sorted blocks of (code, count)

def pack(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted codes as differences, byte planes apart, compressed. ``counts`` may
    carry a tag in its upper 16 bits, the same for every occurrence of a code."""
    d = np.diff(codes, prepend=_U(0))
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes()
    more = np.ascontiguousarray(counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()
    return zstandard.compress(planes + more, 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(2, 8, -1)
    d, c = (np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in raw)
    return np.cumsum(d, dtype=np.uint64), c


def merge(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(b) for b in blocks]
    codes, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts & _COUNT, first) | counts[first] & ~_COUNT if len(first) else counts


def word_shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)


# --- the model, as workers see it

class Words:
    """Level 1."""

    def __init__(self, folder: str, shards: int, base: list[int], total: int):
        self.folder, self.shards, self.base, self.total = folder, shards, np.array(base, np.int64), total
        self.size = int(base[-1])
        self.files: dict[int, tuple] = {}

    def _shard(self, s: int):
        if s not in self.files:
            words = map_file(f"{self.folder}/words-{s}.bin")
            seq = elias_fano.Sequence(words)
            self.files[s] = (seq, words[seq.size:seq.size + seq.n])
        return self.files[s]

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of sorted hashes; id -1 and count 0 where unknown."""
        ids, counts = np.full(len(h), -1, np.int64), np.zeros(len(h), np.int64)
        shard = word_shard(h, self.shards)
        for s in np.unique(shard).tolist():
            if self.base[s + 1] == self.base[s]:
                continue
            at = np.flatnonzero(shard == s)
            seq, c = self._shard(s)
            i = seq.find(h[at])
            ok = i >= 0
            ids[at[ok]] = self.base[s] + i[ok]
            counts[at[ok]] = c[i[ok]].astype(np.int64)
        return ids, counts

    def prior(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.total + self.size + 1)


def parts_of(counts: np.ndarray, split: int) -> np.ndarray:
    return 1 + counts // split


def pair_shard(u: np.ndarray, v: np.ndarray, count_u: np.ndarray, size: int, shards: int, split: int) -> np.ndarray:
    part = v * parts_of(count_u, split) // (size + 1)
    return (mix64(u.astype(np.uint64) ^ (part.astype(np.uint64) << _U(44))) % _U(shards)).astype(np.int64)


def quantised(logp: np.ndarray) -> np.ndarray:
    return np.minimum(np.round(-logp * QUANTUM), 65535).astype(np.uint16)


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, its places) in order."""
    order = np.argsort(shard, kind="stable")
    edge = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-2))
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        yield int(shard[order[a]]), order[a:b]


class Successors:
    """Level 2."""

    def __init__(self, folder: str, shards: int, size: int, split: int, present: dict[int, int]):
        self.folder, self.shards, self.size, self.split, self.present = folder, shards, size, split, present
        self.files: dict[int, tuple] = {}

    def _shard(self, s: int):
        if s not in self.files:
            words = map_file(f"{self.folder}/pairs-{s}.bin")
            contexts = elias_fano.Sequence(words)
            pointers = elias_fano.Sequence(words[contexts.size:])
            values = elias_fano.Sequence(words[contexts.size + pointers.size:])
            codes = np.asarray(words[contexts.size + pointers.size + values.size:]).view(np.uint16)
            self.files[s] = (contexts, pointers, values, codes[:values.n], codes[values.n:2 * values.n])
        return self.files[s]

    def lookup(self, u: np.ndarray, v: np.ndarray, count_u: np.ndarray) -> tuple[np.ndarray, ...]:
        """(shard, place in it, quantised log10 probability, quantised share left to
        the shorter context) of the pairs; place -1 where not seen."""
        shard = pair_shard(u, v, count_u, self.size, self.shards, self.split)
        place, prob, share = np.full(len(u), -1, np.int64), np.zeros(len(u), np.uint16), np.zeros(len(u), np.uint16)
        for s, at in by_shard(shard):
            if s not in self.present:
                continue
            contexts, _, values, probs, shares = self._shard(s)
            cu, inv = np.unique(u[at], return_inverse=True)
            c = contexts.find(cu.astype(np.uint64))[inv]
            at, c = at[c >= 0], c[c >= 0]
            i = values.find(c.astype(np.uint64) * _U(self.size + 1) + v[at].astype(np.uint64))
            at, i = at[i >= 0], i[i >= 0]
            place[at], prob[at], share[at] = i, probs[i], shares[i]
        return shard, place, prob, share

    def successors(self, shard: int, u: int) -> tuple[np.ndarray, np.ndarray]:
        """(follower ids, log10 probabilities) of a context within one shard."""
        contexts, pointers, values, codes, _ = self._shard(shard)
        place = int(contexts.find(np.array([u], np.uint64))[0])
        if place < 0:
            return np.zeros(0, np.int64), np.zeros(0)
        lo, hi = pointers.access(np.array([place, place + 1])).astype(np.int64)
        i = np.arange(lo, hi)
        return (values.access(i) - _U(place) * _U(self.size + 1)).astype(np.int64), -codes[i].astype(np.float64) / QUANTUM


def count_of(share: np.ndarray, mu3: float) -> np.ndarray:
    """A pair's count, about, from the quantised log10 of mu3 / (count + mu3)."""
    return mu3 * (10.0 ** (share / QUANTUM) - 1)


def triple_file(shard: np.ndarray, share: np.ndarray, w: np.ndarray, size: int, mu3: float, split: int) -> np.ndarray:
    """Number of the file of a triple: its pair's shard and the follower's part."""
    parts = np.minimum(parts_of(count_of(share, mu3).astype(np.int64), split), PARTS)
    return shard * PARTS + w * parts // (size + 1)


class Continuations:
    """Level 3."""

    def __init__(self, folder: str, size: int, mu3: float, split: int, present: set[int]):
        self.folder, self.size, self.mu3, self.split, self.present = folder, size, mu3, split, present
        self.files: dict[int, tuple] = {}

    def _file(self, key: int):
        if key not in self.files:
            words = map_file(f"{self.folder}/triples-{key}.bin")
            pointers = elias_fano.Sequence(words)
            values = elias_fano.Sequence(words[pointers.size:])
            self.files[key] = (pointers, values, np.asarray(words[pointers.size + values.size:]).view(np.uint16))
        return self.files[key]

    def lookup(self, shard: np.ndarray, place: np.ndarray, share: np.ndarray, w: np.ndarray) -> np.ndarray:
        """log10 probability of the followers ``w`` of seen pairs, nan where not seen."""
        out = np.full(len(w), np.nan)
        for key, at in by_shard(triple_file(shard, share, w, self.size, self.mu3, self.split)):
            if key not in self.present:
                continue
            pointers, values, codes = self._file(key)
            c = place[at]
            lo, hi = pointers.access(c), pointers.access(c + 1)
            i = values.find_between(c.astype(np.uint64) * _U(self.size + 1) + w[at].astype(np.uint64), lo, hi)
            out[at[i >= 0]] = -codes[i[i >= 0]].astype(np.float64) / QUANTUM
        return out

    def successors(self, key: int, place: int) -> tuple[np.ndarray, np.ndarray]:
        """(follower ids, log10 probabilities) of the pair at a place, within one file."""
        pointers, values, codes = self._file(key)
        i = np.arange(*pointers.access(np.array([place, place + 1])).astype(np.int64))
        return (values.access(i) - _U(place) * _U(self.size + 1)).astype(np.int64), -codes[i].astype(np.float64) / QUANTUM


class Model:
    """What travels to the workers: places and sizes; the levels are opened there.
    ``pairs``: number of pairs per shard; ``triples``: the files of triples."""

    def __init__(self, folder, shards, base, total, documents, mu, mu3, split):
        self.folder, self.shards, self.base, self.total = folder, shards, base, total
        self.documents, self.mu, self.mu3, self.split = documents, mu, mu3, split
        self.pairs: dict[int, int] = {}
        self.triples: set[int] = set()

    @property
    def size(self) -> int:
        return int(self.base[-1])

    def open(self) -> tuple[Words, Successors, Continuations]:
        key = (self.folder, len(self.pairs), len(self.triples))
        if key not in _OPEN:
            while len(_OPEN) > 1:
                _OPEN.pop(next(iter(_OPEN)))
            _OPEN[key] = (Words(self.folder, self.shards, self.base, self.total),
                          Successors(self.folder, self.shards, self.size, self.split, self.pairs),
                          Continuations(self.folder, self.size, self.mu3, self.split, self.triples))
        return _OPEN[key]


_OPEN: dict = {}


def _encoded(model: Model, texts: list[str | None]):
    """Per token: id, count, the context's id and count; tokens per text. The
    start of a text has the id V; unknown words have -1."""
    words, *_ = model.open()
    h, n = token_hashes(texts)
    u, inv = np.unique(h, return_inverse=True)
    ids, counts = (x[inv] for x in words.lookup(u))
    first = np.cumsum(n) - n
    ctx, ctx_count = np.roll(ids, 1), np.roll(counts, 1)
    ctx[first], ctx_count[first] = model.size, model.documents
    return ids, counts, ctx, ctx_count, n


class Located:
    """The distinct pairs of a slice (follower, shard, place, quantised
    probability and share), per token its pair (-1: with an unknown word) and,
    per distinct triple of seen pairs, its two pairs and first token."""

    def __init__(self, model: Model, ids, ctx, ctx_count, n):
        self.pair = np.full(len(ids), -1, np.int64)
        at = np.flatnonzero((ids >= 0) & (ctx >= 0))
        code, pick, self.pair[at] = np.unique(ctx[at].astype(np.uint64) << _U(32) | ids[at].astype(np.uint64),
                                              return_index=True, return_inverse=True)
        del code
        self.follower = ids[at[pick]]
        self.shard, self.place, self.prob, self.share = model.open()[1].lookup(ctx[at[pick]], self.follower, ctx_count[at[pick]])
        seen = np.append(self.place >= 0, False)       # the last one for the pair -1
        before = np.roll(self.pair, 1)
        before[np.cumsum(n) - n] = -1
        self.after = np.flatnonzero(seen[before])      # tokens behind a seen pair
        self.before = before[self.after]
        self.seen = np.flatnonzero(seen[self.pair])
        self.at = np.flatnonzero(seen[before] & seen[self.pair])
        self.code = before[self.at].astype(np.uint64) << _U(32) | self.pair[self.at].astype(np.uint64)

    def pairs_of(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (code >> _U(32)).astype(np.int64), (code & _U(0xFFFFFFFF)).astype(np.int64)


# --- building

def _blocks(df: DataFrame, combine) -> DataFrame:
    """(shard, block): sorted blocks of one slice's n-grams for each shard."""
    schema = pa.schema([("shard", pa.int64()), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, SLICE):
            codes, counts, shard = combine(part.column(0).to_pylist())
            order = np.lexsort((codes, shard))
            codes, counts, shard = codes[order], counts[order], shard[order]
            edge = np.flatnonzero(np.diff(shard, prepend=-1, append=-2))
            cuts = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
            if cuts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(shard[a]) for a, _ in cuts], pa.int64()),
                     pa.array([pack(codes[a:b], counts[a:b]) for a, b in cuts], pa.binary())], schema=schema)

    return df.select("text").mapInArrow(run, "shard bigint, block binary")


def _merged(blocks: DataFrame, finish, parts: int) -> list:
    """Merge each shard's blocks, let ``finish`` write it; (shard, n, total) rows."""
    schema = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("total", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush():
            codes, counts = merge(held)
            finish(now, codes, counts)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([len(codes)], pa.int64()),
                                               pa.array([int((counts & _COUNT).sum())], pa.int64())], schema=schema)

        for batch in batches:
            for s, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if s != now:
                    if held:
                        yield flush()
                    now, held = s, []
                held.append(b)
        if held:
            yield flush()

    dealt = blocks.repartition(parts, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "shard bigint, n bigint, total bigint").collect()   # a row per shard


def build(df: DataFrame, text_col: str = "text", mu: float = 20.0, mu3: float = 5.0, shards: int | None = None,
          split: int = SPLIT) -> Model:
    """The model of all texts of ``df``."""
    spark = df.sparkSession
    texts = df.select(F.col(text_col).cast("string").alias("text"))
    folder = shared_folder(spark, "lm")
    shards = shards or max(8, 2 * texts.rdd.getNumPartitions())   # grows with the input

    def count_words(t):
        h, _ = token_hashes(t)
        codes, counts = np.unique(h, return_counts=True)
        return codes, counts, word_shard(codes, shards)

    def write_words(s, codes, counts):
        write_file(f"{folder}/words-{s}.bin", elias_fano.encode(codes) + counts.astype(np.uint64).tobytes())

    got = {r["shard"]: r for r in _merged(_blocks(texts, count_words), write_words, shards)}
    base = np.cumsum([0, *(got[s]["n"] if s in got else 0 for s in range(shards))]).tolist()
    documents = texts.count()
    model = Model(folder, shards, base, sum(r["total"] for r in got.values()), documents, mu, mu3, split)
    size = model.size
    if size + 1 >= 1 << 32:
        raise ValueError("word ids need more than 32 bits: pass more selective texts or widen the pair codes")

    def count_pairs(t):
        ids, _, ctx, ctx_count, _ = _encoded(model, t)
        codes, at, counts = np.unique(ctx.astype(np.uint64) << _U(32) | ids.astype(np.uint64), return_index=True, return_counts=True)
        return codes, counts, pair_shard(ctx[at], ids[at], ctx_count[at], size, shards, split)

    def write_pairs(s, codes, counts):
        words, *_ = model.open()
        u, v = (codes >> _U(32)).astype(np.int64), (codes & _U(0xFFFFFFFF)).astype(np.int64)
        contexts, first, place = np.unique(u, return_index=True, return_inverse=True)
        followers, inv = np.unique(v, return_inverse=True)
        prior = words.prior(_counts_of(words, followers))[inv]
        cu = _counts_of(words, contexts, documents)[place]
        prob = quantised(np.log10((counts + mu * prior) / (cu + mu)))
        write_file(f"{folder}/pairs-{s}.bin",
                   elias_fano.encode(contexts.astype(np.uint64))
                   + elias_fano.encode(np.append(first, len(u)).astype(np.uint64))
                   + elias_fano.encode(place.astype(np.uint64) * _U(size + 1) + v.astype(np.uint64))
                   + _pad(prob.tobytes() + quantised(np.log10(mu3 / (counts + mu3))).tobytes()))

    def count_triples(t):
        ids, _, ctx, ctx_count, n = _encoded(model, t)
        got = Located(model, ids, ctx, ctx_count, n)
        code, counts = np.unique(got.code, return_counts=True)
        i, j = got.pairs_of(code)
        w = got.follower[j]
        return (got.place[i].astype(np.uint64) << _U(32) | w.astype(np.uint64),
                counts.astype(np.uint64) | got.prob[j].astype(np.uint64) << _U(48),
                triple_file(got.shard[i], got.share[i], w, size, mu3, split))

    def write_triples(key, codes, counts):
        place, w = (codes >> _U(32)).astype(np.int64), codes & _U(0xFFFFFFFF)
        shares = model.open()[1]._shard(key // PARTS)[4]
        shorter = 10.0 ** (-(counts >> _U(48)).astype(np.float64) / QUANTUM)
        prob = ((counts & _COUNT) + mu3 * shorter) / (count_of(shares[place], mu3) + mu3)
        pointers = np.searchsorted(place, np.arange(model.pairs[key // PARTS] + 1))
        write_file(f"{folder}/triples-{key}.bin",
                   elias_fano.encode(pointers.astype(np.uint64))
                   + elias_fano.encode(place.astype(np.uint64) * _U(size + 1) + w)
                   + _pad(quantised(np.log10(np.minimum(prob, 1.0))).tobytes()))

    if size:
        model.pairs = {r["shard"]: r["n"] for r in _merged(_blocks(texts, count_pairs), write_pairs, shards)}
        model.triples = {r["shard"] for r in _merged(_blocks(texts, count_triples), write_triples, shards)}
    return model


def _counts_of(words: Words, ids: np.ndarray, start: int = 0) -> np.ndarray:
    """Counts of sorted word ids; the id V is the start of a text."""
    out = np.full(len(ids), start, np.int64)
    shard = np.searchsorted(words.base, ids, side="right") - 1
    for s in np.unique(shard[ids < words.size]).tolist():
        at = np.flatnonzero((shard == s) & (ids < words.size))
        out[at] = words._shard(s)[1][ids[at] - words.base[s]].astype(np.int64)
    return out


# --- scoring

def score_texts(model: Model, texts: list[str | None]):
    """(n_tokens, n_known, base_score, score) arrays."""
    words, _, continuations = model.open()
    ids, counts, ctx, ctx_count, n = _encoded(model, texts)
    prior = np.log10(words.prior(counts))
    p = np.where(ctx >= 0, np.log10(model.mu / (ctx_count + model.mu)) + prior, prior)
    if model.pairs:
        got = Located(model, ids, ctx, ctx_count, n)
        p[got.seen] = -got.prob[got.pair[got.seen]].astype(np.float64) / QUANTUM
        p[got.after] -= got.share[got.before] / QUANTUM
        code, inv = np.unique(got.code, return_inverse=True)
        i, j = got.pairs_of(code)
        seen = continuations.lookup(got.shard[i], got.place[i], got.share[i], got.follower[j])[inv]
        p[got.at] = np.where(np.isnan(seen), p[got.at], seen)
    first = np.cumsum(n) - n
    return n, np.add.reduceat((counts > 0).astype(np.int64), first), np.add.reduceat(prior, first), np.add.reduceat(p, first)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per row."""
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in grouped(batches, SLICE):
            n, known, base, total = score_texts(model, part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                                              pa.array([model.total] * len(n), pa.int64()), pa.array(base), pa.array(total)], schema=schema)

    return src.mapInArrow(run, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
