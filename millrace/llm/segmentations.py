"""Operator 2: sampled SentencePiece segmentations without replacement.

A text's lattice has an edge for every piece of the vocabulary that fits; a segmentation is a path, and its
probability is the product of its pieces' weights over that of all paths. Gumbel top-k perturbs the log
probability of every path once and returns the k largest. The search never lists paths: it keeps
regions of the lattice ("as this path up to here, then something else"), each with the largest perturbed value
of its paths, which can be drawn from the region's mass alone. That bound is exact, so taking the best region
first (A*) yields the distinct paths in order of their perturbed values.

No piece reaches across the blank before a word or across a line break, so the lattice is a chain of word
lattices, and each distinct word's is built once.
"""

from __future__ import annotations

import functools
import math
import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import textnum as tn
from millrace.llm import vocabulary
from millrace.llm.common import of_worker, small_batches

_BLANK = "▁"
_LITERAL = "\udfff"  # a U+2581 of the text itself; no valid text has this code point


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Pieces:
    """The vocabulary as weights. ``alpha`` flattens or sharpens: a piece of merge rank r weighs (1 + r)**-alpha."""

    def __init__(self, path: str, alpha: float) -> None:
        model = vocabulary.piece_model(path)
        size = model.get_piece_size()
        self.weights: dict[str, tuple[int, float]] = {}
        self.byte_ids = [0] * 256
        self.bytes_: list[bytes] = []
        self.last = -alpha * math.log(1 + size)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:-1], 16)] = i
                self.bytes_.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_.append(b"")
            else:
                # pieces that no merge makes have scores far below all ranks; they weigh as much as the last
                self.weights[piece] = (i, max(-alpha * math.log(1 + max(-model.get_score(i), 0.0)), self.last))
                self.bytes_.append(piece.replace(_BLANK, " ").encode())
        self.sizes = np.array(list(map(len, self.bytes_)), dtype=np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes_line = np.frombuffer(b"".join(self.bytes_), np.uint8)
        self._index()

    def _index(self) -> None:
        """The trie of all pieces as a hash table of its edges, to walk it from many places of a text at once."""
        trie: list[dict[int, int]] = [{}]
        ids, weights = [-1], [0.0]
        alphabet = {c: k + 1 for k, c in enumerate(sorted({ord(c) for piece in self.weights for c in piece}))}
        for piece, (i, w) in self.weights.items():
            at = 0
            for c in piece:
                onward, c = trie[at], alphabet[ord(c)]
                if c not in onward:
                    onward[c] = len(trie)
                    trie.append({})
                    ids.append(-1)
                    weights.append(0.0)
                at = onward[c]
            ids[at], weights[at] = i, w
        self.node_ids, self.node_weights = np.array(ids), np.array(weights)
        self.classes = np.zeros(max(alphabet) + 2, dtype=np.int32)  # 0: no piece has the character
        self.classes[list(alphabet)] = list(alphabet.values())
        self.width = len(alphabet) + 1
        keys = np.array([at * self.width + c for at, onward in enumerate(trie) for c in onward])
        nodes = np.array([to for onward in trie for to in onward.values()])
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys, self.nodes = np.append(keys[order], -1), np.append(nodes[order], 0).astype(np.int32)
        self.slots = np.full(1 << 20, -1, dtype=np.int32)
        first, begin, many = np.unique(slot[order], return_index=True, return_counts=True)
        self.slots[first] = begin
        self.depth = int(many.max())

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(tn.BASE)) >> np.uint64(44)

    def onward(self, nodes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the trie's nodes go on with a character, and where to."""
        keys = nodes.astype(np.int64) * self.width + classes
        at = self.slots[self._slot(keys)]
        some = np.flatnonzero(at >= 0)
        at, keys = at[some], keys[some]
        hit = self.keys[at] == keys
        for _ in range(self.depth - 1):
            at = np.where(hit, at, np.minimum(at + 1, len(self.keys) - 1))
            hit = self.keys[at] == keys
        return some[hit], self.nodes[at[hit]]


@functools.cache
def _pieces(path: str, alpha: float) -> _Pieces:
    return _Pieces(path, alpha)


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each beginning on, as many as its size, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


class _Column:
    """Numbers that grow in place."""

    def __init__(self, dtype: type) -> None:
        self.room, self.size = np.empty(1024, dtype), 0

    def grow(self, more: int) -> np.ndarray:
        """The places of ``more`` new numbers, to be filled in."""
        if self.size + more > len(self.room):
            wider = np.empty(max(2 * len(self.room), self.size + more), self.room.dtype)
            wider[: self.size] = self.all()
            self.room = wider
        self.size += more
        return self.room[self.size - more : self.size]

    def keep(self, numbers: np.ndarray) -> None:
        """Replace the numbers by no more others."""
        self.size = len(numbers)
        self.room[: self.size] = numbers

    def all(self) -> np.ndarray:
        return self.room[: self.size]


class _Lattices:
    """Word lattices as flat tables. A node's edges stand together, each with the probability of those before it.

    Beyond ``limit`` words only those stay that come again and again: most distinct words of a corpus are seen once or twice.
    """

    def __init__(self, pieces: _Pieces, limit: int = 150_000) -> None:
        self.pieces, self.limit = pieces, limit
        self.types: dict[str, int] = {}
        self.uses = np.zeros(0, dtype=np.int32)  # of each type, in calls of of()
        self.first, self.last = _Column(np.int64), _Column(np.int64)  # nodes of each type
        self.begin = _Column(np.int64)  # of each node's edges, and where the last one's end
        self.begin.keep(np.zeros(1, dtype=np.int64))
        self.below, self.logp, self.rest = _Column(np.float64), _Column(np.float64), _Column(np.float32)
        self.to, self.piece = _Column(np.int32), _Column(np.int32)

    def of(self, words: list[str], spell: Callable[[str], str] = str) -> np.ndarray:
        """The types of distinct words; the lattices of new ones are built together. ``spell`` replaces characters, one by one."""
        known = list(map(self.types.get, words))
        new = [i for i, t in enumerate(known) if t is None]
        if new:
            fresh = [words[i] for i in new]
            for i, w in zip(new, fresh):
                known[i] = self.types[w] = len(self.types)
            self.uses = np.concatenate([self.uses, np.zeros(len(new), dtype=np.int32)])
            self._build(spell("".join(fresh)), np.fromiter(map(len, fresh), np.int64, len(fresh)))
        types = np.array(known, dtype=np.int64)
        self.uses[types] += 1
        return types

    def make_room(self) -> None:
        """Beyond the limit, keep the types used more than once, up to half of it by their uses, and count these half from then on."""
        if len(self.types) <= self.limit:
            return
        often = np.argsort(-self.uses, kind="stable")[: self.limit // 2]
        often = np.sort(often[self.uses[often] > 1])
        names = list(self.types)
        self.types = {names[t]: k for k, t in enumerate(often.tolist())}
        self.uses = self.uses[often] >> 1
        # a word's nodes stand together, and so do its edges
        first, last, begin = self.first.all()[often], self.last.all()[often], self.begin.all()
        nodes, edges = last + 1 - first, begin[last + 1] - begin[first]
        less = first - (np.cumsum(nodes) - nodes)
        kept = _ranges(begin[first], edges)
        self.begin.keep(np.concatenate([[0], np.cumsum(np.diff(begin)[_ranges(first, nodes)])]))
        self.first.keep(first - less)
        self.last.keep(last - less)
        self.to.keep(self.to.all()[kept] - np.repeat(less, edges))
        for held in (self.below, self.piece, self.logp, self.rest):
            held.keep(held.all()[kept])

    def _build(self, line: str, sizes: np.ndarray) -> None:
        """Lattices of words that stand in one line, by their sizes."""
        p = self.pieces
        points = _points(line)
        n, words = len(points), len(sizes)
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(words), sizes)
        left = ends[word] - np.arange(n)  # characters from here to the word's end
        node = np.arange(n) + word  # every word has one node more than characters
        classes = p.classes[np.minimum(points, len(p.classes) - 1)]
        found, count = [], np.zeros(n, dtype=np.int64)  # edges, and how many of them each character has
        at, state, size = np.arange(n), np.zeros(n, dtype=np.int32), 0
        while len(at):
            going, state = p.onward(state, classes[at + size])
            at, size = at[going], size + 1
            made = np.flatnonzero(p.node_ids[state] >= 0)
            where, ends_in = at[made], state[made]
            weight, piece = p.node_weights[ends_in], p.node_ids[ends_in]
            if size == 1:  # where no piece makes a character its bytes do
                bare = np.ones(n, dtype=bool)
                bare[where] = False
                bare = np.flatnonzero(bare)
                character = np.where(points[bare] == ord(_LITERAL), ord(_BLANK), points[bare]).astype(np.int64)
                cost = p.last * (1 + (character > 0x7F) + (character > 0x7FF) + (character > 0xFFFF))
                ids = np.where(character < 0x80, np.array(p.byte_ids)[np.minimum(character, 0x7F)], -1 - character)
                where, weight, piece = np.concatenate([where, bare]), np.concatenate([weight, cost]), np.concatenate([piece, ids])
            found.append((where, count[where], size, weight, piece))
            count[where] += 1
            more = left[at] > size
            at, state = at[more], state[more]
        heads = np.cumsum(count) - count
        edges = int(count.sum())
        at = np.repeat(np.arange(n), count)
        length, weight, piece = np.zeros(edges, np.int64), np.zeros(edges), np.zeros(edges, np.int64)
        for where, rank, size, w, ids in found:  # by character and size
            place = heads[where] + rank
            length[place], weight[place], piece[place] = size, w, ids
        onward = node[at] + length
        total = np.zeros(n + words)
        # by distance from the word's end: every node comes after those it leads to
        order = np.argsort(left.astype(np.uint16) if left.max() < 1 << 16 else left, kind="stable")
        many = count[order]
        starts = np.cumsum(many) - many
        levelled = np.arange(edges) + np.repeat(heads[order] - starts, many)
        w, reach = weight[levelled], onward[levelled]
        levels = np.flatnonzero(np.diff(left[order], prepend=0))
        for i, j in zip(levels.tolist(), [*levels[1:].tolist(), n]):
            lo, hi = starts[i], starts[j] if j < n else edges
            values, inner = w[lo:hi] + total[reach[lo:hi]], starts[i:j] - lo
            best = np.maximum.reduceat(values, inner)
            total[node[order[i:j]]] = best + np.log(np.add.reduceat(np.exp(values - np.repeat(best, many[i:j])), inner))
        # whole multiples of 2^-30, of which sums are exact and so do not depend on what stands beside a text
        logp = np.round(np.minimum(weight + total[onward] - total[node[at]], 0.0) * 2**30) / 2**30
        share = np.exp(logp)
        running = np.cumsum(share)
        upto = np.minimum(running - np.repeat(running[heads] - share[heads], count), 1.0)
        below = np.concatenate([[0.0], upto[:-1]]) if edges else upto
        below[heads] = 0.0
        # what the other edges have: for a large share they are summed up, as 1 - share would lose its digits
        large = share > 0.5
        others = np.repeat(np.add.reduceat(np.where(large, 0.0, share), heads), count)
        rest = np.where(large, others, 1.0 - share)
        # in the order of nodes; a word's last node has a place among the edges, but no edge
        base = self.begin.size - 1
        place = np.arange(edges) + word[at]
        last = np.cumsum(np.bincount(word, count, minlength=words).astype(np.int64)) + np.arange(words)
        ends_at = ends + np.arange(words)
        per_node = np.ones(len(total), dtype=np.int64)
        per_node[node] = count
        until = self.begin.all()[-1]
        self.begin.grow(len(per_node))[:] = np.cumsum(per_node) + until
        for held, values, finals in (
            (self.below, below, 0.0), (self.to, onward + base, ends_at + base), (self.piece, piece, 0), (self.logp, logp, 0.0), (self.rest, rest, 0.0)
        ):
            column = held.grow(edges + words)
            column[place], column[last] = values, finals
        self.first.grow(words)[:] = ends - sizes + np.arange(words) + base
        self.last.grow(words)[:] = ends + np.arange(words) + base


def chunks(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts, one after another, and how many each text has.

    Every text gets a blank in front; a word is a line break, or blanks and what follows up to the next of either.
    """
    data, offs = tn.buffers(texts)
    full = np.diff(offs) > 0
    ends = offs[1:] + np.cumsum(full)
    begins = np.concatenate([[0], ends[:-1]])
    line = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
    line[np.arange(len(data)) + np.repeat(np.cumsum(full), np.diff(offs))] = data
    stop, blank = line == 0x0A, line == 0x20
    new = stop | blank
    new[1:] = stop[1:] | stop[:-1] | (blank[1:] & ~blank[:-1])
    new[begins[full]] = True
    at = np.flatnonzero(new)
    words = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(at, len(line)).astype(np.int32)), pa.py_buffer(line)])
    return words.dictionary_encode(), np.diff(np.searchsorted(at, np.append(begins, len(line))))


def _spelled(word: str) -> str:
    """Words of a text as pieces spell them: a blank is U+2581, and what is a U+2581 already matches no piece."""
    return word.replace(_BLANK, _LITERAL).replace(" ", _BLANK)


def _uniform(seeds: np.ndarray, number: int) -> np.ndarray:
    """Numbers in (0, 1), the ``number``-th of each seed."""
    h = tn.mix(seeds + np.uint64(number * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


#: Numbers of the draws of a word: 2^20 steps for each path, then the bounds of its regions.
_STEPS, _BOUND = 1 << 20, 1 << 40


class _Sampler:
    """Draws words' segmentations. The edges of what has been drawn stand in a pool; a segmentation is a range of it."""

    def __init__(self, lat: _Lattices) -> None:
        # views: the tables must not change while a sampler lives
        tables = (lat.first, lat.last, lat.begin, lat.to, lat.below, lat.logp, lat.rest)
        self.first, self.last, self.begin, self.to, self.below, self.logp, self.rest = (x.all() for x in tables)
        self.pools: list[np.ndarray] = []
        self.held = 0

    def keep(self, edges: np.ndarray) -> None:
        self.pools.append(edges)
        self.held += len(edges)

    def _edge(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each node at ``u``. The longest pieces, which come last, are the likeliest, so the search goes backwards."""
        e = self.begin[node + 1] - 1
        open_ = np.flatnonzero(u <= self.below[e])
        while len(open_):
            before = e[open_] - 1
            e[open_] = before
            open_ = open_[u[open_] <= self.below[before]]
        return e

    def draw(self, types: np.ndarray, seeds: np.ndarray, path: int) -> tuple[np.ndarray, ...]:
        """Log probability, probability of all others, start and size in the pool of one segmentation of each word."""
        n = len(types)
        if not n:
            return np.zeros(0), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        # so that the search walks through the tables in order
        by_type = np.sort((types << 32) | np.arange(n)) & 0xFFFFFFFF
        types, seeds = types[by_type], seeds[by_type]
        node, end = self.first[types], self.last[types]
        logp, rest, size = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64)
        who, steps = np.flatnonzero(node != end), []
        # of the words that are not through yet
        node, end, seeds, gone, others = node[who], end[who], seeds[who], np.zeros(len(who)), np.zeros(len(who))
        while len(who):
            e = self._edge(node, _uniform(seeds, path * _STEPS + len(steps)))
            node = self.to[e]
            others += np.exp(gone) * self.rest[e]
            gone += self.logp[e]
            steps.append((who, e))
            on = node != end
            through = np.flatnonzero(~on)
            w = who[through]
            logp[w], rest[w], size[w] = gone[through], others[through], len(steps)
            on = np.flatnonzero(on)
            who, node, end, seeds, gone, others = (x[on] for x in (who, node, end, seeds, gone, others))
        inside = np.cumsum(size) - size
        grown = np.zeros(int(size.sum()), dtype=np.int64)
        for k, (who, e) in enumerate(steps):
            grown[inside[who] + k] = e
        start = self.held + inside
        self.keep(grown)
        back = np.empty(n, dtype=np.int64)
        back[by_type] = np.arange(n)
        return logp[back], rest[back], start[back], size[back]

    def edges(self, start: int, size: int) -> tuple[int, ...]:
        """A segmentation from the pool."""
        for pool in self.pools:
            if start < len(pool):
                return tuple(pool[start : start + size].tolist())
            start -= len(pool)
        return ()

    def _edges_of(self, node: int) -> tuple[int, list[float]]:
        """A node's first edge, and the log probabilities of all."""
        begin, end = self.begin[node : node + 2].tolist()
        return begin, self.logp[begin:end].tolist()

    def _trie(self, word: int, excluded: list[tuple[int, ...]]) -> list[list]:
        """Nodes of the excluded segmentations' trie: lattice node, next trie node by edge, probability of what is not excluded."""
        trie: list[list] = [[int(self.first[word]), {}, 0.0]]
        for path in excluded:
            at = 0
            for e in path:
                onward = trie[at][1]
                if e not in onward:
                    onward[e] = len(trie)
                    trie.append([int(self.to[e]), {}, 0.0])
                at = onward[e]
        for entry in reversed(trie):  # children come after their parents
            node, onward, _ = entry
            if onward:
                begin, logp = self._edges_of(node)
                entry[2] = sum(math.exp(x) * trie[onward[e]][2] if e in onward else math.exp(x) for e, x in enumerate(logp, begin))
        return trie

    def other(self, word: int, excluded: list[tuple[int, ...]], rng: random.Random) -> tuple[tuple[int, ...], float, float]:
        """A segmentation that is none of the excluded, its log probability, and the probability of all that are then left."""
        trie = self._trie(word, excluded)
        node, end, at = int(self.first[word]), int(self.last[word]), 0
        path, logp = [], 0.0
        while node != end:
            onward = trie[at][1] if at >= 0 else {}
            begin, steps = self._edges_of(node)
            shares = [math.exp(x) * (trie[onward[e]][2] if e in onward else 1.0) for e, x in enumerate(steps, begin)]
            u = rng.random() * sum(shares)
            chosen = max(range(len(shares)), key=shares.__getitem__)  # should rounding leave u over
            for k, p in enumerate(shares):
                if u < p:
                    chosen = k
                    break
                u -= p
            e = begin + chosen
            path.append(e)
            logp += steps[chosen]
            node, at = int(self.to[e]), onward.get(e, -1)
        return tuple(path), logp, self._trie(word, [*excluded, tuple(path)])[0][2]


def _bounded(location: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel values at ``location`` that are at most ``bound``."""
    with np.errstate(over="ignore", invalid="ignore"):
        value = -np.logaddexp(-bound, np.log(-np.log(u)) - location)
    return np.where(np.isfinite(location), value, -np.inf)


def top_segmentations(types: np.ndarray, offs: np.ndarray, rows: np.ndarray, lat: _Lattices, k: int) -> list[dict[str, np.ndarray]]:
    """For each rank: row, log_prob, perturbed, threshold, and the ids' ranges word by word.

    ``types`` are the word types of all rows one after another, ``offs`` the rows' offsets, ``rows`` their seeds.
    """
    sampler = _Sampler(lat)
    n, words = len(offs) - 1, len(types)
    row = np.repeat(np.arange(n), np.diff(offs))
    index = np.arange(words) - offs[row]
    seeds = tn.mix(rows[row] + (index.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
    begins, full = offs[:-1], offs[1:] > offs[:-1]
    logp = np.zeros((k, words))
    start, size = np.zeros((k, words), dtype=np.int64), np.zeros((k, words), dtype=np.int64)
    bound = np.full((k, words), -np.inf)  # of the region that leaves path r at this word
    excluded: dict[tuple[int, int], list[tuple[int, ...]]] = {}  # there, if more than the path's own segmentation
    alive = np.ones(n, dtype=bool)
    parent, since = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    value = -np.log(-np.log(_uniform(rows, 0)))  # the largest of all paths
    top = np.full(n, -np.inf)
    results = []

    def regions(r: int, at: np.ndarray, rest: np.ndarray, number: int) -> None:
        before = np.concatenate([[0.0], np.cumsum(logp[r])])
        with np.errstate(divide="ignore"):
            location = before[at] - before[begins][row[at]] + np.log(rest)
        bound[r, at] = _bounded(location, value[row[at]], _uniform(seeds[at], _BOUND + number))

    for r in range(k):
        live = alive[row]
        if r:
            same = np.flatnonzero(live & (index < since[row]))
            for x in (logp, start, size):
                x[r, same] = x[parent[row[same]], same]
            who = np.flatnonzero(alive)
            drawn, left = [], []
            for d, p, w in zip(who.tolist(), parent[who].tolist(), (begins + since)[who].tolist()):
                known = excluded.setdefault((p, w), [sampler.edges(int(start[p, w]), int(size[p, w]))])
                path, logp[r, w], rest = sampler.other(int(types[w]), known, random.Random(int(rows[d]) * 64 + r))
                known.append(path)
                start[r, w], size[r, w] = sampler.held + sum(map(len, drawn)), len(path)
                drawn.append(path)
                left.append(rest)
            sampler.keep(np.array([e for path in drawn for e in path], dtype=np.int64))
        fresh = np.flatnonzero(live & (index > since[row]))
        logp[r, fresh], others, start[r, fresh], size[r, fresh] = sampler.draw(types[fresh], seeds[fresh], r)
        if r:  # what is left of the regions that this rank's paths come from lies below these paths' values
            for p in range(r):
                mine = parent[who] == p
                regions(p, (begins + since)[who[mine]], np.array(left)[mine], 200 + r)
        regions(r, fresh, others, 100 + r)
        before = np.concatenate([[0.0], np.cumsum(logp[r])])
        sums = before[offs[1:]] - before[begins]
        results.append({"row": np.flatnonzero(alive), "log_prob": sums[alive], "perturbed": value[alive], "start": start[r], "size": size[r]})
        # the best region of each row
        top, parent = np.full(n, -np.inf), np.zeros(n, dtype=np.int64)
        for p in range(r + 1) if words else ():
            mine = np.full(n, -np.inf)
            mine[full] = np.maximum.reduceat(bound[p], begins[full])
            better = mine > top
            top[better], parent[better] = mine[better], p
        alive = alive & np.isfinite(top)
        if r == k - 1 or not alive.any():
            break
        value = top
        since = np.full(n, -1, dtype=np.int64)
        for p in range(r + 1):
            at = np.flatnonzero(alive[row] & (parent[row] == p) & (bound[p] == value[row]))
            since[row[at][::-1]] = index[at][::-1]  # the first, should two be equal
    pool = lat.piece.all()[np.concatenate(sampler.pools)].astype(np.int64)
    for result in results:
        result["threshold"], result["pool"] = top[result["row"]], pool
    return results


def _ids(codes: np.ndarray, offs: np.ndarray, pieces: _Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids and their offsets, with each character that no piece makes replaced by the pieces of its bytes."""
    bare = np.flatnonzero(codes < 0)
    if not len(bare):
        return codes, offs
    spelled = [[pieces.byte_ids[b] for b in chr(-1 - c).encode()] for c in codes[bare].tolist()]
    many = np.ones(len(codes), dtype=np.int64)
    many[bare] = list(map(len, spelled))
    out = np.repeat(codes, many)
    out[np.repeat(codes < 0, many)] = [i for ids in spelled for i in ids]
    return out, np.concatenate([[0], np.cumsum(many)])[offs]


def _texts(ids: np.ndarray, offs: np.ndarray, pieces: _Pieces) -> pa.Array:
    """The texts that runs of piece ids stand for, without the blank that every text begins with."""
    sizes = pieces.sizes[ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.ones(total, dtype=np.int64)  # steps through the pieces' bytes, summed up
    full = np.flatnonzero(sizes)
    if len(full):
        begins = pieces.begins[ids[full]]
        at[0] = begins[0]
        at[(ends - sizes)[full[1:]]] = begins[1:] - (begins[:-1] + sizes[full[:-1]] - 1)
        np.cumsum(at, out=at)
    data = pieces.bytes_line[at]
    upto = np.concatenate([[0], ends])[offs]
    blank = np.zeros(len(offs) - 1, dtype=np.int64)
    some = np.flatnonzero(np.diff(upto))
    blank[some] = data[upto[some]] == 0x20
    keep = np.ones(total, dtype=bool)
    keep[upto[some][blank[some] > 0]] = False
    upto = upto - np.concatenate([[0], np.cumsum(blank)])
    raw = data[keep]
    try:
        raw.tobytes().decode()
    except UnicodeDecodeError:  # bytes that make no characters; no segmentation of a text has them
        return pa.array([raw[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(upto[:-1].tolist(), upto[1:].tolist())], pa.string())
    return pa.Array.from_buffers(pa.string(), len(offs) - 1, [None, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(raw)])


def _sampled(path: str, alpha: float, k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path, alpha)
        lat = of_worker(f"lattices {path} {alpha}", lambda: _Lattices(pieces))
        for whole in batches:
            for i, j in tn.slices(whole["text"]):
                batch = whole.slice(i, j - i)
                lat.make_room()
                words, sizes = chunks(batch["text"])
                types = lat.of(words.dictionary.to_numpy(zero_copy_only=False).tolist(), _spelled)[words.indices.to_numpy()]
                offs = np.concatenate([[0], np.cumsum(sizes)])
                seeds = tn.mix(batch["seed"].to_numpy().view(np.uint64) + np.uint64(seed))
                for rank, result in enumerate(top_segmentations(types, offs, seeds, lat, k)):
                    pool, rows = result["pool"], result["row"]
                    s, z = result["start"], result["size"]
                    if len(rows) < len(sizes):  # rows that have no such rank
                        there = np.isin(np.repeat(np.arange(len(sizes)), sizes), rows)
                        s, z = s[there], z[there]
                    ends = np.cumsum(z)
                    codes = pool[np.arange(ends[-1] if len(z) else 0) + np.repeat(s - ends + z, z)]
                    words_upto = np.concatenate([[0], np.cumsum(sizes[rows])])
                    ids, upto = _ids(codes, np.concatenate([[0], ends])[words_upto], pieces)
                    x = result["log_prob"] - result["threshold"]
                    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
                        # for very small x, exp(x) is the inclusion itself, and x its logarithm
                        log_inclusion = np.where(x < -36, x, np.log(-np.expm1(-np.exp(x))))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["key"].take(pa.array(rows)), pa.array(np.full(len(rows), rank)), pa.array(result["log_prob"]), pa.array(result["perturbed"]),
                            pa.array(np.exp(log_inclusion)), pa.array(log_inclusion),
                            pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((4 * upto).astype(np.int32)), pa.py_buffer(ids.astype("<i4"))]),
                            _texts(ids, upto, pieces),
                        ],
                        ["key", "rank", "log_prob", "perturbed", "inclusion", "log_inclusion", "ids", "text"],
                    )

    return run


def sample(df: DataFrame, k: int, *, key: str = "doc_id", text: str = "text", model_path: str | None = None, alpha: float = 0.3, seed: int = 3) -> DataFrame:
    """key, rank, log_prob, perturbed, inclusion, log_inclusion, ids, text: up to ``k`` distinct segmentations of each row's whole text.

    Ranks count from 0 by falling perturbed log probability. inclusion is the probability that the segmentation's
    own perturbed value exceeds that of the first one left out (1 if none is); it underflows for long texts, its logarithm
    log_inclusion does not. ids are little-endian 32-bit; text is what they decode to. The key
    seeds the draws: rows of equal key and text get equal samples, wherever and however often they run. A null or
    empty text has one segmentation, of no pieces; a text with fewer than ``k`` has fewer rows. An empty table
    gives an empty result; other columns are ignored.
    """
    small_batches(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{key}`")).alias("seed"))
    kind = rows.schema["key"].dataType.simpleString()
    run = _sampled(model_path or vocabulary.default_path("piece_bpe_32k.model"), alpha, k, seed)
    schema = f"key {kind}, rank long, log_prob double, perturbed double, inclusion double, log_inclusion double, ids binary, text string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(ids: Column, model_path: str | None = None) -> Column:
    """The text of a binary of little-endian 32-bit ids; the inverse of every segmentation. A null stays null."""
    path = model_path or vocabulary.default_path("piece_bpe_32k.model")

    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        pieces, held = _pieces(path, 1.0), ids.fill_null(b"").to_pylist()
        offs = np.cumsum([0, *(len(raw) // 4 for raw in held)])
        texts = _texts(np.frombuffer(b"".join(held), "<i4").astype(np.int64), offs, pieces)
        return pc.if_else(ids.is_null(), pa.scalar(None, pa.string()), texts)

    return decoded(ids)
