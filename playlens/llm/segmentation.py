"""SentencePiece encoding with sampling without replacement, and decoding.

The lattice of a text has an edge for every vocabulary piece that matches at a position. Pieces get a
Zipf prior by vocabulary rank, which makes a segmentation a random path whose continuations are known
exactly from backward sums. The ``k`` segmentations with the largest Gumbel-perturbed log-probabilities
are a sample of ``k`` distinct ones; they are found by a best-first (A-star) search over sets of paths:
a set's key is the perturbed value of its best path, drawn from its total mass and truncated by its
parent's. The first path of a set is completed by drawing, the rest of the set is split lazily at its
first steps, so a text costs ``k`` drawn paths and a few splits. The key of the best set left over is the
threshold from which inclusion probabilities follow.

Pieces never hold a word start after other text, so words are independent parts of the lattice: each
distinct word's lattice is built once a task, and all words of a batch are drawn step by step with array
operations. Random numbers are hashes of the row's key, the word's place and the step; batches and
partitions do not change a result.

Defined cases: a null or empty text has one segmentation, without pieces; a text with fewer than ``k``
segmentations gives all of them, with inclusion 1; unknown characters become their UTF-8 bytes' pieces;
rows with equal id and text get equal samples; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import heapq
import math
import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import doc_slices, mix, string_buffer

SAMPLES = 2
ZIPF_SHIFT = 2.7
UNKNOWN_LOGP = -16.0  # per byte of a character without a piece
_START = "▁"
_LITERAL = "\udc81"  # stands for a literal U+2581 in a text; no valid text holds it
_CACHE_WORDS = 150_000
_CACHE_NODES = 2_000_000
_BATCH_BYTES = 1_000_000
_ADD_CHARS = 32_000  # words are added in groups of about so many characters, so work arrays stay small


_NO_PIECES = (np.zeros(1, np.uint64), np.zeros(1, np.int64), np.zeros(1), np.zeros((1 << 16) + 1, np.int32))
_MULT = 0x9E3779B97F4A7C15


def _points(text: str) -> np.ndarray:
    """Code points; the stand-in for a literal U+2581 is a lone surrogate."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """Pieces, their prior and their bytes, from a SentencePiece model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.bytes_of: list[bytes] = [b""] * size
        self.byte_id: dict[int, int] = {}
        plain = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
                self.bytes_of[i] = piece.replace(_START, " ").encode()
                plain.append((-model.get_score(i), i, piece))
                if _START in piece.lstrip(_START) or "\n" in piece:
                    raise ValueError(f"piece {piece!r} spans a word start or line end")
        self.edge: dict[str, tuple[int, float]] = {}
        total = sum(1 / (r + ZIPF_SHIFT) for r in range(len(plain)))
        for r, (_, i, piece) in enumerate(sorted(plain)):
            self.edge[piece] = (i, -math.log((r + ZIPF_SHIFT) * total))
        # Per piece length: sorted hashes of the pieces' code points, their ids and priors, and where each value of the top 16 bits begins.
        self.by_length: dict[int, tuple] = {}
        # Per length: top bits of the hashes of that many first characters of a longer piece; a match ends where they end.
        self.begins: dict[int, np.ndarray] = {}
        for size in sorted({len(p) for p in self.edge}):
            own = [p for p in self.edge if len(p) == size]
            points, hashes = _points("".join(own)).reshape(-1, size), np.zeros(len(own), np.uint64)
            for k in range(size):
                if k:
                    self.begins.setdefault(k, np.zeros(1 << 18, bool))[mix(hashes) >> np.uint64(46)] = True
                hashes = hashes * np.uint64(_MULT) + points[:, k] + np.uint64(1)
            hashes = mix(hashes)
            order = np.argsort(hashes)
            begin = np.searchsorted(hashes[order] >> np.uint64(48), np.arange((1 << 16) + 1)).astype(np.int32)
            self.by_length[size] = (hashes[order], np.array([self.edge[p][0] for p in own], np.int64)[order],
                                    np.array([self.edge[p][1] for p in own])[order], begin)

        # The bytes of all pieces after each other.
        self.spelled, self.widths = np.frombuffer(b"".join(self.bytes_of), np.uint8), np.array([len(x) for x in self.bytes_of])
        self.starts = np.cumsum(self.widths) - self.widths
        self.longest = max(self.by_length, default=1)

    def ids(self, code: int) -> list[int]:
        """Ids of an edge: one piece, or a character (as -1 - code point) by its bytes."""
        if code >= 0:
            return [code]
        char = _START if chr(-1 - code) == _LITERAL else chr(-1 - code)
        return [self.byte_id[b] for b in char.encode()]

    def decode(self, ids) -> str:
        """The text of a segmentation; the inverse of encoding."""
        ids = np.asarray(ids, np.int64)
        width = self.widths[ids]
        shift = self.starts[ids] - np.cumsum(width) + width
        raw = self.spelled[np.arange(width.sum()) + np.repeat(shift, width)].tobytes()
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _vocabulary(path: str) -> Vocabulary:
    """One a worker process, for all of its tasks."""
    return Vocabulary(path)


class Lattices:
    """Flat edge lists of all words seen: per edge its code, nodes, conditional log-probability.

    Nodes of a word are consecutive; ``first[node]`` is its first edge, the longest. ``cdf`` is the
    running probability of a node's edges in 2**-32, so a draw looks at little more than one edge.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.root = vocab, {}
        self.nodes = self.size = 0
        self.code, self.next, self.of = (np.zeros(1024, np.int32) for _ in range(3))
        self.cdf, self.first, self.logp = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(1024)

    def clear(self) -> None:
        """Forgets all words; the arrays are used again."""
        self.root, self.nodes, self.size = {}, 0, 0

    def _room(self, nodes: int, edges: int) -> None:
        """Arrays double when full, one after the other; what is not filled yet takes no memory.

        ``first`` has one entry past the last node.
        """
        for need, names in ((nodes + 1, ("first",)), (edges, ("code", "next", "of", "cdf", "logp"))):
            for name in names:
                old = getattr(self, name)
                if need > len(old):
                    new = np.empty(max(need, 2 * len(old)), old.dtype)
                    new[: len(old)] = old
                    setattr(self, name, new)

    def add(self, words: list[str]) -> None:
        """Adds the lattices of new, distinct, non-empty words."""
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        for a, b in doc_slices(np.concatenate([[0], ends]), _ADD_CHARS):
            self._add(words[a:b])

    def _add(self, words: list[str]) -> None:
        points = _points("".join(words))
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.repeat(np.cumsum(size), size)
        n = len(points)
        left = end - np.arange(n)  # characters from here to the word's end
        hits = []
        live, run = np.arange(n), np.zeros(n, np.uint64)  # places where a piece can still match, hashes of what they match
        count = np.zeros(n, np.int64)
        for length in range(1, self.vocab.longest + 1):
            if length > 1:
                more = (left[live] >= length) & self.vocab.begins[length - 1][mixed >> np.uint64(46)]
                live, run = live[more], run[more]
                if not len(live):
                    break
            run = run * np.uint64(_MULT) + points[live + (length - 1)] + np.uint64(1)
            mixed = mix(run)
            if length > 1 and length not in self.vocab.by_length:
                continue
            hashes, ids, logp, begin = self.vocab.by_length.get(length, _NO_PIECES)
            found, top = np.full(len(live), -1), (mixed >> np.uint64(48)).astype(np.int64)
            k, stop = begin[top], begin[top + 1]
            look = np.flatnonzero(k < stop)
            while len(look):  # the pieces with these top bits, mostly one
                same = hashes[k[look]] == mixed[look]
                found[look[same]] = k[look[same]]
                look = look[~same]
                k[look] += 1
                look = look[k[look] < stop[look]]
            hit = found >= 0
            at, k = live[hit], found[hit]
            if length == 1:
                bare = live[~hit]  # characters without a piece go by their bytes
                raw = points[bare].astype(np.int64)
                width = 1 + (raw > 0x7F) + (raw > 0x7FF) + (raw > 0xFFFF)
                table = np.array([self.vocab.byte_id.get(b, 0) for b in range(128)])
                hits.append((bare, 1, np.where(raw < 128, table[np.minimum(raw, 127)], -1 - raw), UNKNOWN_LOGP * width))
                count[bare] += 1
            hits.append((at, length, ids[k], logp[k]))
            count[at] += 1
        first = np.cumsum(count) - count
        total = int(count.sum())
        node, span, code = (np.zeros(total, np.int64) for _ in range(3))
        prior, place = np.zeros(total), first.copy()
        for at, length, c, p in reversed(hits):  # longest, mostly likeliest, first
            e = place[at]
            node[e], span[e], code[e], prior[e] = at, length, c, p
            place[at] += 1
        target = node + span
        final = target == end[node]
        # Backward sums, one distance from the word's end after the other; edges in the order in which they are needed.
        by_left = np.argsort(left.astype(np.uint16) if size.max() < 1 << 16 else left, kind="stable")
        cuts = np.searchsorted(left[by_left], np.arange(1, left.max() + 2))
        c = count[by_left]
        start = np.concatenate([[0], np.cumsum(c)])
        turn = np.arange(total) - np.repeat(start[:-1] - first[by_left], c)
        value, to = prior[turn], np.where(final, n, target)[turn]
        back = np.zeros(n + 1)  # the last one is the end of a word
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            x, y = start.item(a), start.item(b)
            own = value[x:y]
            own += back[to[x:y]]
            cut = start[a:b] - x
            top = np.maximum.reduceat(own, cut)
            back[by_left[a:b]] = top + np.log(np.add.reduceat(np.exp(own - np.repeat(top, c[a:b])), cut))
        logp = np.empty(total)
        logp[turn] = value
        logp -= back[node]
        rank = np.arange(total) - first[node]
        share = np.exp(logp)
        run, at = share.copy(), first
        for k in range(1, int(count.max())):
            at = at[count[node[at]] > k]
            run[at + k] = share[at + k] + run[at + k - 1]
        last = rank == count[node] - 1
        bits = np.where(last, 1 << 32, np.minimum(run * 2.0**32, 2.0**32).astype(np.int64))
        base, had = self.nodes, self.size
        self.nodes, self.size = base + n, had + total
        self._room(self.nodes, self.size)
        new = slice(had, self.size)
        self.code[new], self.logp[new], self.cdf[new], self.of[new] = code, logp, bits, node + base
        self.next[new] = np.where(final, -1, target + base)
        self.first[base : self.nodes] = first + had
        self.first[self.nodes] = self.size
        for word, at in zip(words, (np.cumsum(size) - size + base).tolist()):
            self.root[word] = at

    def edges(self, node: int) -> range:
        return range(self.first.item(node), self.first.item(node + 1))


def _drawn(lat: Lattices, roots: np.ndarray, keys: np.ndarray, stream: int) -> tuple[np.ndarray, np.ndarray]:
    """(edges, offsets): a drawn path of every word, in word order."""
    after, cdf = lat.next, lat.cdf
    node, at, step = roots, np.arange(len(roots)), 0
    whose, edges = [], []
    while len(at):
        h = mix(keys[at] + np.uint64((step * 64 + stream) * _MULT % (1 << 64)))
        u = (h >> np.uint64(32)).astype(np.int64)
        e = lat.first[node]
        on = np.flatnonzero(cdf[e] <= u)
        while len(on):
            e[on] += 1
            on = on[cdf[e[on]] <= u[on]]
        whose.append(at)
        edges.append(e)
        node = after[e]
        go = node >= 0
        node, at, step = node[go], at[go], step + 1
    if not edges:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    whose, edges = np.concatenate(whose), np.concatenate(edges)
    order = np.argsort(whose, kind="stable")
    return edges[order], np.concatenate([[0], np.cumsum(np.bincount(whose, minlength=len(roots)))])


def _truncated(rng: random.Random, mass: float, top: float) -> float:
    """A Gumbel with location ``mass`` given that it is below ``top``."""
    u = min(max(rng.random(), 1e-300), 1 - 1e-16)
    return mass - _logaddexp(mass - top, math.log(-math.log(u)))


def _logaddexp(a: float, b: float) -> float:
    hi, lo = (a, b) if a > b else (b, a)
    return hi if lo == -math.inf else hi + math.log1p(math.exp(lo - hi))


def _minus(a: float, b: float) -> float:
    """log(exp(a) - exp(b)) for a >= b."""
    return -math.inf if b >= a else a + math.log(-math.expm1(b - a))


def search(lat: Lattices, draw, k: int, rng: random.Random) -> list[tuple]:
    """[(edges, log-probability, perturbed value)] of ``k`` distinct paths, and last the threshold.

    A heap entry is a set of paths that share the first ``step`` edges of a found path: with ``edge`` next,
    or (``edge`` None) all of them but the found path itself.

    ``draw(j)`` gives (edges, offsets) of the j-th drawn path of the text's words.
    """
    logp, weight, after = lat.logp, lat.logp.item, lat.next.item  # single values as Python numbers
    first, of, rand = lat.first.item, lat.of.item, rng.random
    log, log1p, exp, heappush = math.log, math.log1p, math.exp, heapq.heappush
    top = -math.log(-math.log(rng.random() or 1e-300))  # the best of a set of total mass 1
    edges, _ = draw(0)
    out = [(edges, float(logp[edges].sum()), top)]
    heap: list[tuple] = []
    ticket = 0

    def push(value: float, *what) -> None:
        nonlocal ticket
        ticket += 1
        heapq.heappush(heap, (-value, ticket, *what))

    def rest(path: int, step: int, mass: float, below: float) -> None:
        """What shares the first ``step`` edges with a found path, that path excepted."""
        left = _minus(mass, out[path][1]) if step < len(out[path][0]) else -math.inf
        if left > -math.inf:
            push(_truncated(rng, left, below), path, step, mass, None)

    rest(0, 0, 0.0, top)
    while heap and len(out) < k:
        value, _, path, step, mass, edge = heapq.heappop(heap)
        if edge is None:
            # Split into the siblings of the path's next edge and what follows that edge.
            own, own_logp = out[path][0], out[path][1]
            while True:
                e = own.item(step)
                ahead, node = mass + weight(e), of(e)
                sets = [(mass + weight(c), c) for c in range(first(node), first(node + 1)) if c != e]
                left = _minus(ahead, own_logp) if step + 1 < len(own) else -math.inf
                if sets or left == -math.inf:
                    break
                step, mass = step + 1, ahead
            options = [s for s in sets if s[0] > -math.inf] + ([(left, None)] if left > -math.inf else [])
            if not options:
                continue
            if len(options) == 1:
                rand()
                best = 0
            else:
                hi = max([m for m, _ in options])
                shares = [exp(m - hi) for m, _ in options]
                pick, run = rand() * sum(shares), 0.0
                best = len(options) - 1
                for i, share in enumerate(shares):
                    run += share
                    if run >= pick:
                        best = i
                        break
            for i, (m, c) in enumerate(options):
                if i == best:
                    key = value
                else:  # as _truncated
                    u = rand()
                    x, y = m + value, log(-log(1e-300 if u < 1e-300 else 1 - 1e-16 if u > 1 - 1e-16 else u))
                    key = (x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y))) - m
                ticket += 1
                heappush(heap, (key, ticket, path, step + 1, ahead, None) if c is None else (key, ticket, path, step, m, c))
            continue
        head = [*out[path][0][:step].tolist(), edge]
        node = after(edge)
        while node >= 0:  # the rest of the word
            u, run, es = rng.random(), 0.0, lat.edges(node)
            e = es[-1]
            for c in es:
                run += math.exp(weight(c))
                if run >= u:
                    e = c
                    break
            head.append(e)
            node = after(e)
        done = sum(1 for e in head if after(e) < 0)  # words complete so far
        fresh, offsets = draw(len(out))
        found = np.concatenate([np.array(head, np.int64), fresh[offsets[done] :]])
        out.append((found, float(logp[found].sum()), -value))
        rest(len(out) - 1, step + 1, mass, -value)
    return [*out, -heap[0][0] if heap else -math.inf]


def _inclusion(logp: float, threshold: float) -> float:
    """log of the probability that a path passes the threshold."""
    if threshold == -math.inf:
        return 0.0
    x = logp - threshold
    return x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 700.0))))


def _words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, the word at each place, per text its first place): a word is a line end, or text with the blanks before it.

    A text is read with one more blank before it. Blanks of words are ``_START``.
    """
    raw = [(" " + t).encode() if t else b"" for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    if not len(data):
        return [], np.zeros(0, np.int64), offsets
    blank, line = data == 0x20, data == 0x0A
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = line[1:] | line[:-1] | blank[1:] & ~blank[:-1]
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    coded = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
    own = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    if any(_START in t for t in texts):
        own = [w.replace(_START, _LITERAL) for w in own]
    return ([w.replace(" ", _START) for w in own], np.asarray(coded.indices), np.searchsorted(bounds, offsets))


def _encode_rows(vocab: Vocabulary, lat: Lattices, rows: list[tuple], k: int):
    """(row index, rank, ids, log-probability, perturbed value, log inclusion) of each row (key, text)."""
    words, which, first = _words([text for _, text in rows])
    at = list(map(lat.root.get, words))
    new = [i for i, node in enumerate(at) if node is None]
    if new:
        lat.add([words[i] for i in new])
        for i in new:
            at[i] = lat.root[words[i]]
    flat = np.array(at, np.int64)[which]
    spans, count = first.tolist(), np.diff(first)
    seeds = mix(np.array([key for key, _ in rows], np.int64).view(np.uint64)) if rows else np.zeros(0, np.uint64)
    place = np.arange(len(flat)) - np.repeat(first[:-1], count)
    keys = mix(np.repeat(seeds, count) + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    paths = [_drawn(lat, flat, keys, j) for j in range(k)]
    code = lat.code
    for r, (key, text) in enumerate(rows):
        if not text:
            yield r, 0, [], 0.0, 0.0, 0.0
            continue
        a, b = spans[r], spans[r + 1]

        def draw(j):
            edges, offsets = paths[j]
            return edges[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]

        *found, threshold = search(lat, draw, k, random.Random(key))
        for rank, (edges, logp, value) in enumerate(found):
            ids = code[edges]
            if (ids < 0).any():
                ids = np.array([i for c in ids.tolist() for i in vocab.ids(c)], np.int64)
            yield r, rank, ids, logp, value, _inclusion(logp, threshold)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", k: int = SAMPLES, seed: int = 0,
           check: bool = False) -> DataFrame:
    """(doc_id, sample, n_pieces, log_prob, perturbed, log_inclusion, pieces[, round_trip]), ``k`` rows a text.

    ``check`` decodes every sample and compares it with the text.
    """

    def work(batches):
        vocab = _vocabulary(model_path)
        lat = Lattices(vocab)
        for batch in batches:
            _, offsets = string_buffer(batch.column("text"))
            for at, end in doc_slices(offsets, _BATCH_BYTES):  # only these rows become Python values
                part = batch.slice(at, end - at)
                ids, keys, texts = (part.column(c).to_pylist() for c in ("doc_id", "key", "text"))
                if len(lat.root) > _CACHE_WORDS or lat.nodes > _CACHE_NODES:
                    lat.clear()
                cols: list[list] = [[] for _ in range(8)]
                for r, rank, pieces, logp, value, inclusion in _encode_rows(vocab, lat, list(zip(keys, texts)), k):
                    same = check and vocab.decode(pieces) == texts[r]
                    for c, v in zip(cols, (ids[r], rank, len(pieces), logp, value, inclusion, pieces, same)):
                        c.append(v)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), None, pa.bool_()]
                names = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "pieces", "round_trip"]
                keep = 8 if check else 7
                bounds = np.concatenate([[0], np.cumsum(cols[2])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(bounds, np.concatenate(cols[6]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) if t else lists for c, t in zip(cols[:keep], kinds)], names=names[:keep])

    schema = "doc_id long, sample int, n_pieces long, log_prob double, perturbed double, log_inclusion double, pieces array<int>"
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(F.lit(seed), doc_id).alias("key"), text.alias("text")).mapInArrow(
        work, schema + (", round_trip boolean" if check else ""))


def decode(pieces: DataFrame, model_path: str, pieces_col: str = "pieces", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) of rows of piece ids; null ids give a null text."""

    def work(batches):
        vocab = _vocabulary(model_path)
        for batch in batches:
            texts = [None if p is None else vocab.decode(p) for p in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    column: Column = F.col(pieces_col).cast("array<int>")
    return pieces.select(F.col(id_col).cast("long").alias("doc_id"), column.alias("pieces")).mapInArrow(work, "doc_id long, text string")
