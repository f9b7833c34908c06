"""SentencePiece encoding by sampling without replacement from the segmentation lattice, and decoding.

The lattice of a text has an edge for every piece of the vocabulary that matches there.  Backward log-masses turn
each node's edges into a conditional distribution, which makes the mass of any set of completions exact: a perfect
heuristic.  The Gumbel top-k search keeps, for every segmentation found, the perturbed maximum of each set "same up
to here, then another edge"; the largest of all these keys is the next segmentation.  The k segmentations are
distinct and come in the order of their perturbed log-probabilities; with the key that would have come next, each
gets its inclusion probability.

All texts of a batch are searched side by side.  Random numbers are hashes of row key, sample, place and step, so
a row's samples do not depend on what else is in its batch.
"""

from __future__ import annotations

import copy
import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

BLANK = "▁"
_BASE = np.uint64(0x100000001B3)
_UNITS = re.compile(" +[^ \n]*|\n|[^ \n]+")  # with blanks as in texts: most units are ASCII then, which is cheaper to look up
# What a random number is for; the walks' own have 0, so samples may be up to 256.
ROOT, ALTERNATIVE, BRANCH, REMAINDER = (i << 8 for i in range(1, 5))
_BATCH_CHARS = 1 << 19
_SIEVE = 18  # bits
_SCHEMA = "doc_id long, sample int, ids binary, n_pieces int, log_prob double, key double, inclusion double, round_trip boolean"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seed: np.ndarray, sample: int, place, step: int) -> np.ndarray:
    """In (0, 1): one value per seed, sample, place (up to 2**24) and step."""
    counter = (np.asarray(place).astype(np.uint64) + np.uint64((sample << 48) + (step << 24))) * np.uint64(0x9E3779B97F4A7C15)
    return ((_mix(seed + counter) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def surface_text(spelt: bytes) -> bytes:
    """The text of what pieces spell: blanks as they are in texts, without the one in front."""
    text = spelt.replace(BLANK.encode(), b" ")
    return text[1:] if text[:1] == b" " else text


class Surfaces:
    """What the pieces of a model stand for: all that decoding needs."""

    def __init__(self, sp: SentencePieceProcessor):
        self.size = sp.get_piece_size()
        self.byte_ids = {bytes([b]): sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.plain = [i for i in range(self.size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.pieces = [sp.id_to_piece(i) for i in self.plain]
        self.surface = [b""] * self.size
        for i, piece in zip(self.plain, self.pieces, strict=True):
            self.surface[i] = piece.encode()
        for byte, i in self.byte_ids.items():
            self.surface[i] = byte

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text that the ids spell."""
        return surface_text(b"".join(map(self.surface.__getitem__, ids.tolist())))


class Vocabulary(Surfaces):
    """Pieces with log-weights: a unigram model's own scores, or Zipf's law over the ranks of a BPE model, whose
    scores are merge ranks and no probabilities.  A character without a piece is spelt in byte pieces."""

    def __init__(self, proto: bytes, temperature: float = 1.0):
        sp = SentencePieceProcessor(model_proto=proto)
        super().__init__(sp)
        plain, pieces = self.plain, self.pieces
        if any("\n" in p or BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("pieces that go on after a blank or hold a newline are not supported")
        scores = np.array([sp.get_score(i) for i in plain])
        ranked = scores[scores > -1e8]
        by_rank = len(ranked) > 1 and np.array_equal(ranked, np.round(ranked))
        weights = -np.log(np.arange(len(plain)) + 2.0) if by_rank else scores
        weights = (weights - np.logaddexp.reduce(weights)) / temperature
        self.byte_weight = float(weights.min()) - 1.0
        self.longest = max(map(len, pieces))
        self.by_length: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # By the upper bits of a run's hash: the first piece of this length that may be it (-1: none), and may a longer one
        # begin with it; and how many pieces of a length share their upper bits at most.
        self.first_slot = np.full((self.longest + 1, 1 << _SIEVE), -1, np.int32)
        self.may_grow = np.zeros((self.longest + 1, 1 << _SIEVE), bool)
        self.deepest = [0] * (self.longest + 1)
        for length in range(1, self.longest + 1):
            here = [j for j, p in enumerate(pieces) if len(p) == length]
            prefixes = _running_hashes(np.array([[ord(c) for c in pieces[j]] for j in here], np.uint64).reshape(-1, length))
            hashes = prefixes[-1]
            for shorter, h in enumerate(prefixes[:-1], 1):
                self.may_grow[shorter, _upper(h)] = True
            order = np.argsort(hashes)
            upper, slots, sharing = np.unique(_upper(hashes[order]), return_index=True, return_counts=True)
            self.first_slot[length, upper] = slots
            self.deepest[length] = int(sharing.max(initial=0))
            if len(np.unique(hashes)) != len(hashes):
                raise ValueError("two pieces have the same hash")
            self.by_length.append((hashes[order], np.array(plain, np.int32)[here][order], weights[here][order]))

    def spelt(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the ids stand for, one after another, and how many each has."""
        if not hasattr(self, "_lengths"):
            self._lengths = np.fromiter(map(len, self.surface), np.int64, self.size)
            self._starts = np.cumsum(self._lengths) - self._lengths
            self._bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        n = self._lengths[ids]
        small = np.int32 if n.sum() < 1 << 31 else np.int64
        shift = (self._starts[ids] - (np.cumsum(n) - n)).astype(small)
        return self._bytes[np.repeat(shift, n) + np.arange(n.sum(), dtype=small)], n


def _running_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Of the first one, two, .. columns."""
    hashes = [np.zeros(len(codes), np.uint64)]
    for column in codes.T:
        hashes.append(hashes[-1] * _BASE + _mix(column + np.uint64(1)))
    return hashes[1:]


def _upper(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - _SIEVE)).astype(np.int64)


class Lattice:
    """The lattices of some distinct units (a text is cut into units that no piece crosses), as flat arrays.

    Edges lie ordered by node, long pieces first; ``upto`` of an edge adds up the probabilities of its node's edges
    up to it.  A unit's last node has no edges.
    """

    def __init__(self, vocabulary: Vocabulary, units: list[str]):
        self.size = vocabulary.size
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.first = np.cumsum(lengths) - lengths + np.arange(len(units))  # each unit has one node more than characters
        place = (np.arange(len(codes)) + np.repeat(np.arange(len(units)), lengths)).astype(np.int32)  # node of each character
        left = (np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))).astype(np.int32)  # characters to the unit's end
        mixed, h = _mix(codes + np.uint64(1)), np.zeros(len(codes), np.uint64)
        node, to, piece, weight = [], [], [], []
        at = np.arange(len(codes))
        for length, (hashes, ids, weights) in enumerate(vocabulary.by_length, 1):
            at = at[left[at] >= length]
            if not len(at):
                break
            grown = h[at] * _BASE + mixed[at + length - 1]
            h[at] = grown
            upper = _upper(grown)
            slot = vocabulary.first_slot[length][upper]
            maybe = np.flatnonzero(slot >= 0)
            if len(maybe):
                slot, wanted = slot[maybe], grown[maybe]
                for _ in range(vocabulary.deepest[length] - 1):
                    slot += (hashes[slot] < wanted) & (slot < len(hashes) - 1)
                hit = hashes[slot] == wanted
                begin, slot = place[at[maybe[hit]]], slot[hit]
                node.append(begin)
                to.append(begin + np.int32(length))
                piece.append(ids[slot])
                weight.append(weights[slot])
            if length == 1:
                spelt = np.setdiff1d(at, at[maybe[hit]], assume_unique=True) if len(maybe) else at
            at = at[vocabulary.may_grow[length][upper]]
        node, to, piece, weight = (x[::-1] for x in (node, to, piece, weight))
        # A character without a piece: one edge, standing for its bytes.
        self.spellings: list[list[int]] = []
        if len(spelt):
            characters, which = np.unique(codes[spelt], return_inverse=True)
            encoded = [chr(int(c)).encode("utf-8", "surrogatepass") for c in characters]
            self.spellings = [[vocabulary.byte_ids[bytes([b])] for b in e] for e in encoded]
            node.append(place[spelt])
            to.append(place[spelt] + np.int32(1))
            piece.append((vocabulary.size + which).astype(np.int32))
            weight.append(vocabulary.byte_weight * np.array([len(e) for e in encoded])[which])
        node, to, piece, weight = (np.concatenate(x) for x in (node, to, piece, weight))
        order = np.argsort(node, kind="stable")
        self.node, self.to, self.piece, weight = (x[order] for x in (node, to, piece, weight))
        self.n_nodes = len(codes) + len(units)
        self.is_last = np.zeros(self.n_nodes, bool)
        self.is_last[self.first + lengths] = True
        self.probability = self._probabilities(weight, left, place)
        starts = np.flatnonzero(np.r_[True, self.node[1:] != self.node[:-1]])
        sizes = np.diff(np.r_[starts, len(self.node)])
        self.below = np.zeros(len(self.node))
        rows = starts[sizes > 1] + 1  # node by node, so that nothing depends on what else is in the lattice
        while len(rows):
            self.below[rows] = self.below[rows - 1] + self.probability[rows - 1]
            rows = rows[rows + 1 < len(self.node)] + 1
            rows = rows[self.node[rows] == self.node[rows - 1]]
        self.upto = self.below + self.probability
        self.upto[starts + sizes - 1] = 1.0
        self.start = np.zeros(self.n_nodes, np.int64)
        self.start[self.node[starts]] = starts
        self.single = np.repeat(sizes == 1, sizes)

    def joined(self, other: Lattice, room: dict[str, np.ndarray]) -> Lattice:
        """The units of both, one's own first.

        The arrays are parts of those in ``room``, where one's own stay in place and only the other's are written, behind
        them; what an earlier call wrote there is gone.
        """
        both, n_edges, n_plain = copy.copy(self), np.int32(len(self.node)), self.size
        pieces = other.piece + np.where(other.piece >= n_plain, len(self.spellings), 0).astype(np.int32)
        both.spellings = self.spellings + other.spellings
        both.n_nodes = self.n_nodes + other.n_nodes
        moved = {"piece": pieces, "first": other.first + self.n_nodes, "node": other.node + np.int32(self.n_nodes),
                 "to": other.to + np.int32(self.n_nodes), "start": other.start + n_edges}
        for name in (*moved, "is_last", "probability", "below", "upto", "single"):
            mine, others = getattr(self, name), moved.get(name, getattr(other, name))
            end = len(mine) + len(others)
            if name not in room or len(room[name]) < end:
                room[name] = np.empty(end + end // 4, mine.dtype)
                room[name][:len(mine)] = mine
                setattr(self, name, room[name][:len(mine)])
            room[name][len(mine):end] = others
            setattr(both, name, room[name][:end])
        return both

    def log(self, edges: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(self.probability[edges])

    def log_rest(self, edges: np.ndarray) -> np.ndarray:
        """Log-probability of the other edges at the same node."""
        return np.where(self.single[edges], -np.inf, np.log(np.maximum(1.0 - self.probability[edges], 1e-300)))

    def _probabilities(self, weight: np.ndarray, left: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Of each edge at its node: backward log-masses, from the nodes nearest to their unit's end on."""
        distance = np.zeros(self.n_nodes, np.int64)
        distance[place] = left
        steps = distance[self.node]
        small = steps.astype(np.uint16) if len(steps) and steps.max() < 1 << 16 else steps  # sorted by radix
        order = np.argsort(small, kind="stable")
        node, to, weight_by = self.node[order], self.to[order], weight[order]
        steps = steps[order]
        bounds = np.searchsorted(steps, np.arange(1, (steps.max() if len(steps) else 0) + 2))
        mass = np.zeros(self.n_nodes)
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            total = weight_by[lo:hi] + mass[to[lo:hi]]
            starts = np.flatnonzero(np.r_[True, node[lo:hi][1:] != node[lo:hi][:-1]])
            top = np.maximum.reduceat(total, starts)
            summed = np.add.reduceat(np.exp(total - np.repeat(top, np.diff(np.r_[starts, hi - lo]))), starts)
            mass[node[lo:hi][starts]] = top + np.log(summed)
        return np.minimum(np.exp(weight + mass[self.to] - mass[self.node]), 1.0)

    def draw(self, node: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node: the first whose probabilities up to it exceed ``u``.  Long pieces come first and
        are likely, so few edges are looked at."""
        edge = self.start[node]
        rest = np.flatnonzero(u >= self.upto[edge])
        while len(rest):
            edge[rest] += 1
            rest = rest[u[rest] >= self.upto[edge[rest]]]
        return edge

    def draw_other(self, node: np.ndarray, u: np.ndarray, taken: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """An edge of each node other than the taken ones (pairs of edge numbers and a mask of where they count)."""
        share = [np.where(use, self.probability[edge], 0.0) for edge, use in taken]
        x = u * np.maximum(1.0 - sum(share), 0.0)
        ranked = np.argsort(np.stack([np.where(use, edge, -1) for edge, use in taken]), axis=0)
        for row in range(len(taken)):
            pick = ranked[row], np.arange(len(node))
            edge = np.stack([np.where(use, edge, -1) for edge, use in taken])[pick]
            skip = (edge >= 0) & (x >= self.below[np.maximum(edge, 0)])
            x = np.where(skip, x + self.probability[np.maximum(edge, 0)], x)
        return self.draw(node, np.minimum(x, 1.0 - 2.0 ** -50))


class KnownUnits:
    """The lattices of units that came up in more than one batch, at most about ``most`` nodes of them."""

    def __init__(self, vocabulary: Vocabulary, most: int = 1 << 19):
        self.vocabulary, self.most = vocabulary, most
        self.numbers: dict[str, int] = {}
        self.kept = Lattice(vocabulary, ["\n"])
        self.room: dict[str, np.ndarray] = {}
        self.met: set[int] = set()

    def lattice_of(self, units: list[str]) -> tuple[Lattice, np.ndarray]:
        """A lattice that has all the units, until the next call, and the number of each in it."""
        kinds = pa.array(units, pa.string()).dictionary_encode()
        here = kinds.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.numbers.get, here, repeat(-1)), np.int64, len(here))
        new = np.flatnonzero(numbers < 0)
        if self.kept.n_nodes < self.most:
            hashes = [hash(here[i]) for i in new.tolist()]
            met = np.fromiter(map(self.met.__contains__, hashes), bool, len(hashes))
            again, new = new[met], new[~met]
            if len(again):
                numbers[again] = len(self.kept.first) + np.arange(len(again))
                kept = [here[i] for i in again.tolist()]
                self.numbers.update(zip(kept, numbers[again].tolist(), strict=True))
                self.kept = self.kept.joined(self._lattice(kept), self.room)
            if len(self.met) > self.most >> 2 or self.kept.n_nodes >= self.most:
                self.met = set()
            self.met.update(compress(hashes, ~met))
        lattice = self.kept
        if len(new):
            numbers[new] = len(self.kept.first) + np.arange(len(new))
            lattice = self.kept.joined(self._lattice([here[i] for i in new.tolist()]), self.room)
        return lattice, numbers[kinds.indices.to_numpy()]

    def _lattice(self, units: list[str]) -> Lattice:
        return Lattice(self.vocabulary, [unit.replace(" ", BLANK) for unit in units])


class _Path:
    """One segmentation of each text of a batch: edges one after another, with the keys of their alternatives."""

    def __init__(self, edges: np.ndarray, sizes: np.ndarray, unit: np.ndarray):
        self.edges, self.sizes, self.unit = edges, sizes, unit  # unit: place in the batch of the edge's unit
        self.starts = np.cumsum(sizes) - sizes
        self.text = np.repeat(np.arange(len(sizes)), sizes)
        self.total = np.zeros(1)  # log-probabilities added up, of none, one, two, .. edges


def _walk(lattice: Lattice, node: np.ndarray, place: np.ndarray, within: np.ndarray, seed: np.ndarray, sample: int):
    """Edges drawn from the given nodes to their units' ends, ordered by place and step; and their places."""
    went, steps, step = [], [], 1
    alive = np.flatnonzero(~lattice.is_last[node])
    node = node.copy()
    count = np.zeros(len(node), np.int64)
    while len(alive):
        edge = lattice.draw(node[alive], _uniform(seed[alive], sample, within[alive], step))
        went.append((alive, edge))
        steps.append(step - 1)
        count[alive] += 1
        node[alive] = lattice.to[edge]
        alive = alive[~lattice.is_last[node[alive]]]
        step += 1
    start = np.cumsum(count) - count
    edges = np.empty(int(count.sum()), np.int64)
    for (rows, edge), s in zip(went, steps, strict=True):
        edges[start[rows] + s] = edge
    return edges, np.repeat(place, count)


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


def _below(top: np.ndarray, mass: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Perturbed maximum of a set with the given log-mass, known to lie below ``top``."""
    return -np.logaddexp(-top, np.log(-np.log(u)) - mass)


def sample_batch(vocabulary: Vocabulary, texts: list[str], seeds: np.ndarray, k: int, known: KnownUnits | None = None):
    """For each text up to ``k`` distinct segmentations: (ids, log-probability, key, inclusion probability)."""
    cut = [_UNITS.findall(" " + t.replace(BLANK, " ")) if t else [] for t in texts]
    n_units = np.fromiter(map(len, cut), np.int64, len(cut))
    root_key = _gumbel(_uniform(seeds, ROOT, np.zeros(len(texts)), 0))
    if not n_units.sum():
        return [[(np.empty(0, np.int32), 0.0, float(key), 1.0)] for key in root_key]
    known = known or KnownUnits(vocabulary)
    lattice, kinds = known.lattice_of(list(chain.from_iterable(cut)))
    del cut
    unit_start = np.cumsum(n_units) - n_units
    unit_text = np.repeat(np.arange(len(texts)), n_units)
    within, unit_seed = np.arange(len(kinds)) - unit_start[unit_text], seeds[unit_text]
    begin = lattice.first[kinds]

    paths: list[_Path] = []
    keys: list[np.ndarray] = []  # of the alternatives at each edge of each path
    found = np.empty((k, len(texts)))  # key of each sample; -inf: there is none
    log_prob = np.full((k, len(texts)), -np.inf)
    parent = np.full((k, len(texts)), -1, np.int64)  # the path that a sample left, and where
    parent_at = np.full((k, len(texts)), -1, np.int64)
    branch = np.zeros((k, len(texts)), np.int64)  # edge taken there

    def add(edges: np.ndarray, unit: np.ndarray, top: np.ndarray, sample: int, fresh_from: np.ndarray) -> None:
        sizes = np.bincount(unit_text[unit], minlength=len(texts))
        path = _Path(edges, sizes, unit)
        logs = lattice.log(edges)
        cum = np.cumsum(logs)
        path.total = np.r_[0.0, cum]
        base = path.total[path.starts]
        before = cum - logs - base[path.text]
        log_prob[sample] = np.where(sizes > 0, path.total[path.starts + sizes] - base, 0.0)
        at = np.arange(len(edges)) - path.starts[path.text]
        key = np.full(len(edges), -np.inf)
        rows = np.flatnonzero((at >= fresh_from[path.text]) & ~lattice.single[edges])
        key[rows] = _below(top[path.text[rows]], before[rows] + lattice.log_rest(edges[rows]),
                           _uniform(seeds[path.text[rows]], ALTERNATIVE + sample, at[rows], 0))
        paths.append(path)
        keys.append(key)

    def best() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text: the largest key of all alternatives, its path and its place in that path's arrays."""
        value, which, place = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for r, (path, key) in enumerate(zip(paths, keys, strict=True)):
            rows = np.flatnonzero(path.sizes)
            top = np.maximum.reduceat(key, path.starts[rows]) if len(rows) else np.empty(0)
            order = np.flatnonzero(key == np.repeat(top, path.sizes[rows]))
            first = np.full(len(texts), -1, np.int64)
            first[path.text[order[::-1]]] = order[::-1]
            better = rows[top > value[rows]]
            value[better] = key[first[better]]
            which[better], place[better] = r, first[better]
        return value, which, place

    edges, unit = _walk(lattice, begin, np.arange(len(kinds)), within, unit_seed, 0)
    found[0] = root_key
    add(edges, unit, found[0], 0, np.zeros(len(texts), np.int64))
    for sample in range(1, k + 1):
        value, which, place = best()
        if sample == k:
            threshold = value
            break
        found[sample] = value
        rows = np.flatnonzero(value > -np.inf)
        left_edge, left_unit, at = (np.zeros(len(texts), np.int64) for _ in range(3))
        before_mass = np.zeros(len(texts))
        for r, path in enumerate(paths):
            own = rows[which[rows] == r]
            left_edge[own], left_unit[own], at[own] = path.edges[place[own]], path.unit[place[own]], place[own] - path.starts[own]
            before_mass[own] = path.total[place[own]] - path.total[path.starts[own]]
        parent[sample, rows], parent_at[sample, rows] = which[rows], at[rows]
        node = lattice.node[left_edge[rows]]
        taken = [(left_edge[rows], np.ones(len(rows), bool))]
        for other in range(1, sample):
            same = (parent[other, rows] == which[rows]) & (parent_at[other, rows] == at[rows])
            taken.append((branch[other, rows], same))
        branch[sample, rows] = lattice.draw_other(node, _uniform(seeds[rows], BRANCH + sample, at[rows], 0), taken)
        # What is left at that place after this edge has gone too.
        gone = sum(np.where(use, lattice.probability[e], 0.0) for e, use in taken) + lattice.probability[branch[sample, rows]]
        edges_there = np.searchsorted(lattice.node, node, side="right") - np.searchsorted(lattice.node, node)
        used = sum(use.astype(np.int64) for _, use in taken) + 1
        with np.errstate(divide="ignore"):
            rest = np.where(edges_there > used, np.log(np.maximum(1.0 - gone, 1e-300)), -np.inf)
        again = np.where(rest > -np.inf, _below(value[rows], before_mass[rows] + rest,
                                                _uniform(seeds[rows], REMAINDER + sample, at[rows], 0)), -np.inf)
        for r in range(len(paths)):
            own = which[rows] == r
            keys[r][place[rows[own]]] = again[own]
        # Prefix of the path left, the other edge, and a fresh walk from there on.
        units = np.flatnonzero((value > -np.inf)[unit_text] & (np.arange(len(kinds)) >= left_unit[unit_text]))
        start_node = begin[units]
        here = units == left_unit[unit_text[units]]
        start_node[here] = lattice.to[branch[sample, unit_text[units[here]]]]
        fresh, fresh_unit = _walk(lattice, start_node, units, within[units], unit_seed[units], sample)
        parts = [(np.full(len(rows), 1, np.int64), branch[sample, rows], left_unit[rows]),
                 (np.full(len(fresh), 2, np.int64), fresh, fresh_unit)]
        for r, path in enumerate(paths):
            own = np.zeros(len(texts), bool)
            own[rows[which[rows] == r]] = True
            head = np.flatnonzero(own[path.text] & (np.arange(len(path.edges)) - path.starts[path.text] < at[path.text]))
            parts.append((np.zeros(len(head), np.int64), path.edges[head], path.unit[head]))
        phase, edges, unit = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((phase, unit_text[unit]))  # stable: each part is in order already
        add(edges[order], unit[order], value, sample, at + 1)
    return _results(vocabulary, lattice, paths, found, log_prob, threshold)


def _results(vocabulary, lattice, paths, found, log_prob, threshold):
    with np.errstate(over="ignore"):
        inclusion = np.where(threshold[None] > -np.inf, -np.expm1(-np.exp(log_prob - threshold[None])), 1.0)
    results: list[list] = [[] for _ in range(found.shape[1])]
    for sample, path in enumerate(paths):
        pieces = lattice.piece[path.edges]
        spelt = np.flatnonzero(pieces >= vocabulary.size)
        sizes = path.sizes
        if len(spelt):
            counts = np.ones(len(pieces), np.int64)
            spellings = [lattice.spellings[p - vocabulary.size] for p in pieces[spelt]]
            counts[spelt] = [len(s) for s in spellings]
            ids = np.repeat(pieces, counts)
            ids[np.flatnonzero(ids >= vocabulary.size)] = np.concatenate([np.array(s) for s in spellings])
            sizes = np.bincount(path.text, counts, len(sizes)).astype(np.int64)
        else:
            ids = pieces
        ids, ends = ids.astype("<i4"), np.cumsum(sizes)
        for text in np.flatnonzero(found[sample] > -np.inf):
            results[text].append((ids[ends[text] - sizes[text]:ends[text]], float(log_prob[sample, text]),
                                  float(found[sample, text]), float(inclusion[sample, text])))
    return results


_VOCABULARIES: dict[tuple[str, float], Vocabulary] = {}  # of this worker process: the model in use, no more


def _vocabulary(proto, temperature: float) -> Vocabulary:
    key = (hashlib.sha256(proto.value).hexdigest(), temperature)
    if key not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[key] = Vocabulary(proto.value, temperature)
    return _VOCABULARIES[key]


_SURFACES: dict[str, Surfaces] = {}  # the same, for decoding alone


def _surfaces(proto) -> Surfaces:
    key = hashlib.sha256(proto.value).hexdigest()
    if key not in _SURFACES:
        _SURFACES.clear()
        _SURFACES[key] = Surfaces(SentencePieceProcessor(model_proto=proto.value))
    return _SURFACES[key]


def _sample(proto, k: int, temperature: float, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KnownUnits(_vocabulary(proto, temperature))
        for batch in batches:
            ends = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            start = 0
            while start < batch.num_rows:
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + _BATCH_CHARS, side="right")))
                yield _rows(known, batch.slice(start, stop - start), k, texts)
                start = stop

    return run


def _rows(known: KnownUnits, batch: pa.RecordBatch, k: int, decode: bool) -> pa.RecordBatch:
    vocabulary, texts = known.vocabulary, batch.column("text").to_pylist()
    seeds = batch.column("seed").to_numpy().view(np.uint64)
    samples = sample_batch(vocabulary, texts, seeds, k, known)
    counts = np.fromiter(map(len, samples), np.int64, len(samples))
    flat = list(chain.from_iterable(samples))
    n_pieces = np.fromiter((len(s[0]) for s in flat), np.int64, len(flat))
    ids = np.concatenate([s[0] for s in flat]) if flat else np.empty(0, "<i4")
    del samples
    # The round trip: what the ids spell, against the text with its blanks as they are in pieces.
    spelt, n_bytes = vocabulary.spelt(ids)
    ends = np.r_[0, np.cumsum(n_bytes)][np.cumsum(n_pieces)]
    begins = np.r_[0, ends[:-1]]
    wanted = [(BLANK + t.replace(" ", BLANK)).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    same = [spelt[lo:hi].tobytes() == wanted[i] for i, lo, hi in zip(np.repeat(np.arange(len(texts)), counts), begins, ends, strict=True)]
    sample = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
    log_prob, key, inclusion = (np.fromiter((s[i] for s in flat), np.float64, len(flat)) for i in (1, 2, 3))
    offsets = np.r_[0, np.cumsum(n_pieces)].astype(np.int32) * 4
    payload = pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))])
    doc_ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(texts)), counts)))
    rows = pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(sample, pa.int32()), payload, pa.array(n_pieces, pa.int32()), pa.array(log_prob), pa.array(key),
         pa.array(inclusion), pa.array(same, pa.bool_())],
        names=["doc_id", "sample", "ids", "n_pieces", "log_prob", "key", "inclusion", "round_trip"])
    if not decode:
        return rows
    texts = [surface_text(spelt[lo:hi].tobytes()).decode("utf-8", "replace") for lo, hi in zip(begins, ends, strict=True)]
    return rows.append_column("text", pa.array(texts, pa.string()))


def sampled_segmentations(docs: DataFrame, model_file: str, k: int = 2, seed: int = 0, temperature: float = 1.0,
                          text: str = "text", key: str = "doc_id", decode: bool = False) -> DataFrame:
    """Up to ``k`` distinct segmentations of every row's whole text, a row each, by falling perturbed log-probability.

    ids are little-endian 32-bit piece ids; log_prob is the segmentation's log-probability among all of the text,
    inclusion the probability of being among the k given the next key; round_trip says that the ids decode to the
    text (U+2581 reads as a blank).  A null or empty text has one empty segmentation.  Rows with the same key and
    text get the same samples; null keys share a seed.  With ``decode``, text is what the ids decode to, as by ``decoded``,
    in the same worker.
    """
    with open(model_file, "rb") as source:
        proto = docs.sparkSession.sparkContext.broadcast(source.read())  # the vocabulary file
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.col(key).cast("string"), F.lit(seed)).alias("seed"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.mapInArrow(_sample(proto, k, temperature, decode), _SCHEMA + (", text string" if decode else ""))


def _decode(proto, keep: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces = _surfaces(proto)
        for batch in batches:
            texts = [None if i is None else surfaces.decode(np.frombuffer(i, "<i4")).decode("utf-8", "replace")
                     for i in batch.column("ids").to_pylist()]
            names = ["doc_id", "sample", *keep]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(texts, pa.string())], names=[*names, "text"])

    return run


def decoded(rows: DataFrame, model_file: str, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, sample, the columns to ``keep`` and the text that the ids spell (null ids: null; bytes that are no UTF-8
    are replaced)."""
    with open(model_file, "rb") as source:
        proto = rows.sparkSession.sparkContext.broadcast(source.read())
    own = rows.select("doc_id", "sample", *keep, "ids")
    return own.mapInArrow(_decode(proto, keep), T.StructType([*own.schema.fields[:-1], T.StructField("text", T.StringType())]))
