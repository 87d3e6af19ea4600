"""Sampled SentencePiece segmentations: Gumbel top-k without replacement over a text's lattice."""

from __future__ import annotations

import gc
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .hashes import BASE, MULTIPLIERS, mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Segmentations of each text.
SAMPLES = 2
#: Exponent of a piece's weight; lower values make rarer segmentations likelier.
ALPHA = 0.5
#: Characters of text whose units a task looks up at a time, and units whose lattices it remembers.
CHUNK_CHARS, CACHE = 1_000_000, 420_000
#: Characters of text that a task draws segmentations of, and hands over, at a time.
PART_CHARS = 250_000

#: The mark for a space, and the shift in Zipf's law.
MARK, SHIFT = "▁", 2.7
#: Stands for a mark that is in the text itself, which only bytes can spell.
LITERAL = 0x110000
SLOT_BITS = 20
UNITS_AT_ONCE = 2_000


@dataclass
class Vocabulary:
    """The pieces of a model, the ids of its byte pieces, and the log weights of all."""

    pieces: list[str]
    first_byte: int
    weights: np.ndarray
    unit: str = ""

    def __post_init__(self) -> None:
        """The pattern of units: letters, signs that no piece has beside a letter, and all else up to a blank."""
        beside = {c for p in self.pieces for a, b in zip(p, p[1:], strict=False) for c in (a, b) if a.isalpha() or b.isalpha()}
        apart = "".join(re.escape(c) for c in string.punctuation if c not in beside)
        signs = rf"| *+[{apart}]++(?=[^\W\d_]|[ \n\r\t{MARK}]|$)" if apart else ""
        after = rf"(?=[{apart} \n\r\t{MARK}]|$)"
        self.unit = rf" *+[^\W\d_]++{after}{signs}| *[^ \n\r\t{MARK}]+| +|[\n\r\t{MARK}]"

    @staticmethod
    def read(path: str, alpha: float = ALPHA) -> Vocabulary:
        """Read by the driver; workers get the pieces, not the file.

        The model's scores are ranks of merges. A piece of rank r weighs as Zipf's law has it,
        1 / (r + 2.7) over the sum of all, to the power of ``alpha``; a byte as the last rank.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        rank = np.full(n, float(n))
        rank[plain] = np.arange(len(plain))
        weights = -alpha * np.log((rank + SHIFT) * np.sum(1 / (np.arange(n) + SHIFT)))
        first_byte = next(i for i in range(n) if model.is_byte(i))
        return Vocabulary(_only(pieces, plain), first_byte, weights)


def _only(pieces: list[str], plain: list[int]) -> list[str]:
    """The plain pieces; what is no text is empty."""
    out = [""] * len(pieces)
    for i in plain:
        out[i] = pieces[i]
    return out


def units_of(text: str, unit: re.Pattern) -> list[str]:
    """Parts of a text that no piece reaches across: spaces with what follows, and single breaks.

    A space is put before a text that is not empty, as the model's own encoder does.
    """
    return unit.findall(" " + text) if text else []


class _Known(dict):
    """First nodes by unit; -1 for a unit that is not known."""

    def __missing__(self, unit: str) -> int:
        return -1


class Lattices:
    """The lattices of units, with the probability of each edge given its start.

    Nodes and edges of all known units are in flat arrays; a node's edges stand together.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.unit = re.compile(vocabulary.unit)
        self.longest = max(map(len, vocabulary.pieces))
        self.weights = np.append(vocabulary.weights, -np.inf).astype(np.float32)  # the last is for no piece
        ids = np.array([i for i, p in enumerate(vocabulary.pieces) if p])
        size = np.array([len(vocabulary.pieces[i]) for i in ids])
        points = np.frombuffer("".join(vocabulary.pieces).encode("utf-32-le"), dtype=np.uint32)
        sums, inverse = _sums(points)
        at = np.cumsum(size) - size
        hashes = mixed((sums[at + size] - sums[at]) * inverse[at] + MULTIPLIERS[2] * size.astype(np.uint64))
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], ids[order]
        # a table by the top bits, with the last of those that share them; the others are searched for
        slot = (self.hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        self.slots = np.zeros(2**SLOT_BITS, dtype=np.int32)
        self.slots[slot] = np.arange(len(slot))
        self.shared = np.bincount(slot, minlength=2**SLOT_BITS) > 1
        self.reset()

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether there is one) of each hash among the pieces'."""
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        where = self.slots[slot]
        hit = self.hashes[where] == h
        again = np.flatnonzero(self.shared[slot] & ~hit)
        if len(again):
            where[again] = np.minimum(np.searchsorted(self.hashes, h[again]), len(self.hashes) - 1)
            hit[again] = self.hashes[where[again]] == h[again]
        return where, hit

    def reset(self) -> None:
        self.first = _Known()
        gc.freeze()  # collections need not go through what the workers remember
        # room is doubled when it runs out; the last number in use of edge_first is an end
        self.n_nodes, self.n_edges = 0, 0
        self.edge_first = np.zeros(1, dtype=np.int64)
        self.piece, self.target = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.log_p, self.upto, self.others = (np.zeros(0, dtype=np.float32) for _ in range(3))

    def _append(self, name: str, at: int, values: np.ndarray) -> None:
        held = getattr(self, name)
        if at + len(values) > len(held):
            room = np.zeros(max(2 * len(held), at + len(values)), dtype=held.dtype)
            room[:at] = held[:at]
            setattr(self, name, held := room)
        held[at : at + len(values)] = values

    def nodes(self, units: list[str]) -> np.ndarray:
        """The first node of each unit; lattices are made for units not yet known."""
        if len(self.first) > CACHE:
            self.reset()
        found = np.fromiter(map(self.first.__getitem__, units), dtype=np.int64, count=len(units))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [units[i] for i in missing]
            fresh = list(dict.fromkeys(new))
            for at in range(0, len(fresh), UNITS_AT_ONCE):  # as many as a processor's cache holds
                self._add(fresh[at : at + UNITS_AT_ONCE])
            found[missing] = np.fromiter(map(self.first.__getitem__, new), dtype=np.int64, count=len(new))
        return found

    def _add(self, units: list[str]) -> None:
        """Make the units' lattices: all pieces at all places, then sums from the ends back."""
        size = np.fromiter(map(len, units), dtype=np.int64)
        points = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32).copy()
        points[points == ord(MARK)] = LITERAL
        points[points == 0x20] = ord(MARK)
        left = np.repeat(np.cumsum(size), size) - np.arange(len(points))
        node = np.arange(len(points)) + np.repeat(np.arange(len(units)), size)
        sums, inverse = _sums(points)
        piece = np.full((len(points), self.longest), -1, dtype=np.int32)
        at, used = np.arange(len(points)), 1
        for length in range(1, self.longest + 1):
            at = at[left[at] >= length]
            where, hit = self._find(_run_hash(sums, inverse, at, length))
            if hit.any():
                used = length
                piece[at[hit], length - 1] = self.ids[where[hit]]
        piece = piece[:, :used]
        weight = self.weights[piece]
        bare = piece[:, 0] < 0  # a character without a piece is spelled in bytes
        first = np.where(points[bare] < 0x80, self.vocabulary.first_byte, len(self.vocabulary.pieces))
        piece[bare, 0] = first + points[bare].astype(np.int64)
        spelled = np.select([points[bare] < 0x80, points[bare] < 0x800, points[bare] < 0x10000, points[bare] < LITERAL], [1, 2, 3, 4], 3)
        weight[bare, 0] = spelled * self.vocabulary.weights[self.vocabulary.first_byte]
        # from the ends of the units back: the log of the summed weights of all ways to the end
        back = np.zeros(len(points) + len(units) + self.longest, dtype=np.float32)
        ahead = np.arange(1, used + 1)
        by_left = np.argsort(left, kind="stable")
        ends = np.cumsum(np.bincount(left)[1:])
        for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
            rows = by_left[a:b]
            ways = weight[rows] + back[node[rows][:, None] + ahead]
            most = ways.max(axis=1)
            back[node[rows]] = most + np.log(np.exp(ways - most[:, None]).sum(axis=1))
        weight += back[node[:, None] + ahead] - back[node][:, None]
        upto = np.cumsum(np.exp(weight), axis=1)
        row, column = np.nonzero(piece >= 0)
        log_p, piece, upto, target = weight[row, column], piece[row, column], upto[row, column], node[row] + column + 1
        upto[np.append(row[1:] != row[:-1], True)] = 2.0  # the last edge of a node takes what is left
        # of all other edges of the node; none beside a sole edge
        others = np.log1p(-np.minimum(np.exp(log_p), np.float32(1 - 1e-7)))
        others[np.bincount(row, minlength=len(points))[row] == 1] = -np.inf
        count = np.zeros(len(points) + len(units), dtype=np.int64)
        count[node] = np.bincount(row, minlength=len(points))
        first = np.concatenate([[0], np.cumsum(count)])
        shift = self.n_nodes
        self.first.update(zip(units, (np.cumsum(size) - size + np.arange(len(units)) + shift).tolist(), strict=True))
        self._append("edge_first", shift, first + self.n_edges)
        self._append("piece", self.n_edges, piece)
        self._append("target", self.n_edges, target + shift)
        self._append("log_p", self.n_edges, log_p)
        self._append("upto", self.n_edges, upto)
        self._append("others", self.n_edges, others)
        self.n_nodes += len(first) - 1
        self.n_edges += len(piece)

    def paths(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edges, where each unit's edges start): a path sampled for each unit.

        Each step's random number comes from the unit's seed and the step alone.
        """
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        length = np.zeros(len(nodes), dtype=np.int64)
        who, at = np.arange(len(nodes)), nodes
        while len(who):
            # the seed's bits are mixed: a product by another odd number for each step spreads them anew
            odd = np.uint64(pow(int(MULTIPLIERS[3]), len(steps), 2**64))
            u = ((seeds[who] * odd) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
            edge = self.edge_first[at]
            open_ = np.flatnonzero(self.upto[edge] <= u)
            while len(open_):
                edge[open_] += 1
                open_ = open_[self.upto[edge[open_]] <= u[open_]]
            steps.append((who, edge))
            length[who] += 1
            at = self.target[edge]
            more = self.edge_first[at] < self.edge_first[at + 1]
            who, at = who[more], at[more]
        starts = np.concatenate([[0], np.cumsum(length)])
        edges = np.empty(starts[-1], dtype=np.int64)
        for step, (who, edge) in enumerate(steps):
            edges[starts[who] + step] = edge
        return edges, starts


def _sums(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(points)
    base = np.full(n + 1, BASE, dtype=np.uint64)
    back = np.full(n + 1, np.uint64(pow(int(BASE), -1, 2**64)), dtype=np.uint64)
    base[0] = back[0] = 1
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mixed(points.astype(np.uint64) + np.uint64(1)) * np.multiply.accumulate(base)[:n], out=sums[1:])
    return sums, np.multiply.accumulate(back)


def _run_hash(sums: np.ndarray, inverse: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return mixed((sums[at + length] - sums[at]) * inverse[at] + MULTIPLIERS[2:3] * np.uint64(length))


def uniform(seeds: np.ndarray) -> np.ndarray:
    """A number in (0, 1) for each seed."""
    return ((mixed(seeds) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def gumbels(seeds: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform(seeds)))


def below(limit: float, value: float) -> float:
    """A Gumbel variable conditioned to lie below ``limit``."""
    return -float(np.logaddexp(-limit, -value)) if value > -np.inf else -np.inf


@dataclass
class Sample:
    edges: np.ndarray
    log_prob: float
    perturbed: float
    inclusion: float = 1.0


@dataclass
class _Node:
    """A place on a found path and the edges already taken there: all other ways from it."""

    path: int
    token: int
    taken: list[int]
    mass: float


class TopK:
    """Perturbed A* search for a text's k segmentations of the greatest perturbed log probability.

    The text's maximum is a Gumbel variable, attained by a path drawn from the lattice. For each
    place on a found path, all ways that leave it there form one node; its maximum is a Gumbel
    variable with the node's log mass as location, conditioned to lie below the path's. The
    next segmentation is drawn within the node of the greatest maximum, which is then split
    in the same way. So the segmentations come in falling order, each without replacement.
    """

    def __init__(self, lattices: Lattices, seed: int, fresh: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.lattices, self.seed = lattices, seed
        self.fresh = fresh
        self.paths: list[Sample] = []
        self.ranks: list[np.ndarray] = []
        self.units: list[np.ndarray] = []
        self.mass: list[np.ndarray] = []
        self.forks: list[tuple[float, _Node]] = []
        self.chosen: tuple[float, _Node | None] | None = None

    def _seed(self, use: int, number: int) -> np.uint64:
        return np.uint64((self.seed * int(MULTIPLIERS[use]) + number * int(MULTIPLIERS[5])) % 2**64)

    def _draws(self, number: int) -> Iterator[float]:
        at, size = 0, 16
        while True:
            yield from uniform(self._seed(3, 2 * number + 1) + np.arange(at, at + size, dtype=np.uint64) * MULTIPLIERS[1])
            at, size = at + size, size * 2

    def _noise(self, number: int, n: int) -> np.ndarray:
        return gumbels(self._seed(4, number) + np.arange(n, dtype=np.uint64) * MULTIPLIERS[0])

    def _found(self, edges: np.ndarray, unit: np.ndarray, perturbed: float, since: int) -> None:
        """Keep a path and the nodes that leave it from token ``since`` on."""
        log_p = self.lattices.log_p[edges].astype(np.float64)
        total = np.cumsum(log_p)
        before = total - log_p
        # the least of these is at the node with the greatest maximum
        rank = -self._noise(2 * len(self.paths), len(edges)) - before - self.lattices.others[edges]
        rank[:since] = np.inf
        self.paths.append(Sample(edges, float(total[-1]) if len(total) else 0.0, perturbed))
        self.units.append(unit)
        self.mass.append(before)
        self.ranks.append(rank)

    def first(self) -> None:
        edges, starts = self.fresh[0]
        self._found(edges, np.repeat(np.arange(len(starts) - 1), np.diff(starts)), float(self._noise(1, 1)[0]), 0)

    def _best(self) -> tuple[float, _Node | int]:
        best, node = max(self.forks, key=lambda f: f[0], default=(-np.inf, None))
        for i, rank in enumerate(self.ranks):
            if len(rank):
                token = int(np.argmin(rank))
                bound = below(self.paths[i].perturbed, -float(rank[token]))
                if bound > best:
                    best, node = bound, _Node(i, token, [int(self.paths[i].edges[token])], 0.0)
        return best, node

    def threshold(self) -> float:
        return self._best()[0]

    def fork(self) -> int | None:
        """The unit in which the next segmentation leaves one already found; None if there is no next.

        Of the paths drawn anew for it, ``next`` reads those of later units only.
        """
        self.chosen = perturbed, node = self._best()
        return None if node is None or perturbed == -np.inf else int(self.units[node.path][node.token])

    def next(self) -> bool:
        """Find one more segmentation; false if there is none."""
        perturbed, node = self.chosen or self._best()
        self.chosen = None
        if node is None or perturbed == -np.inf:
            return False
        number, lattice = len(self.paths), self.lattices
        if len(node.taken) == 1:
            self.ranks[node.path][node.token] = np.inf
        else:
            self.forks = [f for f in self.forks if f[1] is not node]
        old, unit = self.paths[node.path].edges, self.units[node.path]
        source = node.taken[0]
        first, last = self._edges_beside(source)
        ways = np.array([e for e in range(first, last) if e not in node.taken])
        p = np.exp(lattice.log_p[ways].astype(np.float64))
        draws = self._draws(number)
        way = int(ways[min(np.searchsorted(np.cumsum(p) / p.sum(), next(draws)), len(ways) - 1)])
        rest = [way]
        while lattice.edge_first[t := lattice.target[rest[-1]]] < lattice.edge_first[t + 1]:
            edge, u = int(lattice.edge_first[t]), np.float32(next(draws))
            while lattice.upto[edge] <= u:
                edge += 1
            rest.append(edge)
        here = int(unit[node.token])
        edges, starts = self.fresh[number]
        new = np.concatenate([old[: node.token], rest, edges[starts[here + 1] :]])
        new_unit = np.concatenate([unit[: node.token], np.full(len(rest), here), np.repeat(np.arange(here + 1, len(starts) - 1), np.diff(starts)[here + 1 :])])
        before = float(self.mass[node.path][node.token])
        self._found(new, new_unit, perturbed, node.token + 1)
        if len(ways) > 1:
            taken = [*node.taken, way]
            others = np.array([e for e in ways if e != way])
            mass = before + float(np.log(np.exp(lattice.log_p[others].astype(np.float64)).sum()))
            bound = below(perturbed, mass + float(self._noise(2 * number + 1, 1)[0]))
            self.forks.append((bound, _Node(node.path, node.token, taken, mass)))
        return True

    def _edges_beside(self, edge: int) -> tuple[int, int]:
        node = int(np.searchsorted(self.lattices.edge_first[: self.lattices.n_nodes + 1], edge, side="right")) - 1
        return int(self.lattices.edge_first[node]), int(self.lattices.edge_first[node + 1])

    def run(self, k: int) -> list[Sample]:
        self.first()
        while len(self.paths) < k and self.next():
            pass
        return self.finished()

    def finished(self) -> list[Sample]:
        """The segmentations found, with their inclusion."""
        limit = self.threshold()
        for sample in self.paths:
            # the chance that a segmentation of this probability gets above the next one's maximum
            sample.inclusion = float(-np.expm1(-np.exp(np.clip(sample.log_prob - limit, -700, 700)))) if limit > -np.inf else 1.0
        return self.paths


def ids_of(lattices: Lattices, edges: np.ndarray) -> np.ndarray:
    """The ids of a path; a character without a piece gives its bytes."""
    ids, n = lattices.piece[edges], len(lattices.vocabulary.pieces)
    spelled = np.flatnonzero(ids >= n)
    if not len(spelled):
        return ids
    first = lattices.vocabulary.first_byte
    parts = np.split(ids, np.sort(np.concatenate([spelled, spelled + 1])))
    return np.concatenate([[first + b for b in (MARK if p[0] - n == LITERAL else chr(p[0] - n)).encode()] if len(p) and p[0] >= n else p for p in parts]).astype(np.int32)


class Decoder:
    """Ids back to text."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        n = len(vocabulary.pieces)
        spelled = [p.replace(MARK, " ").encode() for p in vocabulary.pieces]
        spelled[vocabulary.first_byte : vocabulary.first_byte + 256] = [bytes([b]) for b in range(256)]
        self.size = np.array([len(s) for s in spelled])
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        assert len(spelled) == n

    def texts(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each list of ids."""
        whole = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int64)
        size = self.size[whole]
        ends = np.cumsum(size)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[whole] - ends + size, size)
        data = self.data[place].tobytes()
        cuts = np.append(0, ends)[np.cumsum([0, *map(len, ids)])].tolist()
        return [data[a:b].decode(errors="replace")[1:] for a, b in zip(cuts, cuts[1:], strict=False)]


def row_seeds(keys: list[int | None], seed: int) -> np.ndarray:
    """A seed for each row, from its key; null keys share one."""
    return mixed(np.array([(0 if key is None else key * 2 + 1) % 2**64 for key in keys], dtype=np.uint64) + np.uint64(seed) * MULTIPLIERS[1:2])


_loaded: dict[int, Lattices] = {}

SCHEMA = "doc_id long, sample int, n_tokens long, log_prob double, perturbed double, inclusion double, ids array<int>, decodes boolean"


def sampled_pieces(docs: DataFrame, vocabulary: Vocabulary, k: int = SAMPLES, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, sample, n_tokens, log_prob, perturbed, inclusion, ids, decodes): ``k`` rows a text.

    A text's lattice has an edge for each piece at each place, and for a character without a
    piece its bytes. A segmentation's probability is the product of its pieces' weights, over the
    sum of all segmentations'. The ``k`` distinct segmentations of the greatest Gumbel-perturbed log
    probability come in falling order, numbered from 0; a text with fewer segmentations gives
    all it has. ``inclusion`` is the chance that a segmentation of its probability is among those
    above the next one's maximum, so that log_prob's exponential over it weighs a sample without
    bias. ``decodes`` tells that the ids, decoded, are the text byte for byte.

    The random numbers depend on ``seed``, the row's key and the text, so a task that is run again, or on
    other partitions, gives the same rows. Null and empty texts have one segmentation, of no
    ids. Repeated rows give the same samples; null keys share a seed. An empty table gives
    no row. Other columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = _loaded.get(hash(vocabulary.weights.tobytes()))
        if lattices is None:
            _loaded.clear()
            lattices = _loaded[hash(vocabulary.weights.tobytes())] = Lattices(vocabulary)
        decoder = Decoder(vocabulary)

        def encoded(rows: list[tuple[int | None, str]]) -> Iterator[pa.RecordBatch]:
            units = [units_of(text, lattices.unit) for _, text in rows]
            counts = np.array([len(u) for u in units])
            nodes = lattices.nodes(list(chain.from_iterable(units)))
            del units
            begin = np.concatenate([[0], np.cumsum(counts)])
            part = np.cumsum([len(text) for _, text in rows]) // PART_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(rows)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield drawn(rows[a:b], counts[a:b], nodes[begin[a] : begin[b]])

        def drawn(rows: list[tuple[int | None, str]], counts: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
            begin = np.concatenate([[0], np.cumsum(counts)])
            seeds = row_seeds([key for key, _ in rows], seed)
            place = np.arange(begin[-1]) - np.repeat(begin[:-1], counts)
            each = np.repeat(seeds, counts) + place.astype(np.uint64) * BASE
            edges, starts = lattices.paths(nodes, mixed(each))
            searches = []
            for i, (a, b) in enumerate(zip(begin, begin[1:], strict=False)):
                searches.append(TopK(lattices, int(seeds[i]), [(edges[starts[a] : starts[b]], starts[a : b + 1] - starts[a])]))
                searches[-1].first()
            open_ = list(range(len(rows)))
            for m in range(1, k):
                # of a text's units only those behind its fork are drawn anew
                forks = [(i, here) for i in open_ if (here := searches[i].fork()) is not None]
                open_ = [i for i, _ in forks]
                sizes = np.array([counts[i] - here - 1 for i, here in forks], dtype=np.int64)
                ends = np.cumsum(sizes)
                since = np.array([begin[i] + here + 1 for i, here in forks], dtype=np.int64)
                where = np.arange(sizes.sum()) + np.repeat(since - ends + sizes, sizes)
                edges, starts = lattices.paths(nodes[where], mixed(each[where] + np.uint64(m) * MULTIPLIERS[2:3]))
                for (i, here), size, end in zip(forks, sizes, ends, strict=True):
                    own = starts[end - size : end + 1]
                    searches[i].fresh.append((edges[own[0] : own[-1]], np.concatenate([np.zeros(here + 1, dtype=np.int64), own - own[0]])))
                    searches[i].next()
            out: list[tuple] = []
            ids: list[np.ndarray] = []
            texts: list[str] = []
            for search, (key, text) in zip(searches, rows, strict=True):
                for number, sample in enumerate(search.finished()):
                    found = ids_of(lattices, sample.edges)
                    ids.append(found)
                    out.append((key, number, len(found), sample.log_prob, sample.perturbed, sample.inclusion))
                    texts.append(text)
            columns = list(zip(*out, strict=True))
            decodes = [a == b for a, b in zip(decoder.texts(ids), texts, strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, lists, pa.array(decodes, pa.bool_())], names=["doc_id", "sample", "n_tokens", "log_prob", "perturbed", "inclusion", "ids", "decodes"])

        held: list[tuple[int | None, str]] = []
        chars = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.append((key, text.as_py() or ""))
                chars += len(held[-1][1]) + 100
                if chars > CHUNK_CHARS:
                    yield from encoded(held)
                    held, chars = [], 0
        if held:
            yield from encoded(held)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, SCHEMA)


def op6_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document."""
    return sampled_pieces(table(spark, sf_dir, "documents"), Vocabulary.read(MODEL))
