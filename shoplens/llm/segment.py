"""SentencePiece segmentations sampled without replacement by Gumbel top-k.

A text's segmentations are the paths of a lattice whose edges are vocabulary pieces (and the UTF-8 bytes of characters that no
piece holds). Every path's log-probability is perturbed with Gumbel noise, and the paths with the ``k`` largest perturbed
values are emitted: that is sampling ``k`` distinct segmentations without replacement. Paths are never listed. A node
of the search (all paths with a common beginning) carries the largest perturbed value below it; the root's is one
Gumbel draw, a node hands its value to one child, drawn by probability, and its other children get Gumbels truncated at
it. Best-first (A-star) search pops the largest value: following the child that inherits it gives a whole path, and the
siblings passed on the way join the frontier. Siblings are drawn only while the beginning before them has a probability
above exp(-``HEAD``); all later ones are one frontier node of exact mass, opened only if it is popped.

The lattice falls apart at white space (no piece of the model has a space mark after another character, which is checked
on loading), so node masses are made per word unit and remembered; paths of all texts of a batch are drawn in lockstep.
All noise is a hash of the row's key, the sample and the place: results do not depend on batches or partitions.

The model holds merge ranks instead of probabilities: a piece of rank r has weight 1 / (r + 10) to the power ``alpha``
(the n-th piece of the vocabulary has rank n); a byte counts as the last rank.

Inclusion score: the chance that a path's perturbed value exceeds the (k+1)-th one, as importance weights need it (1 when
there are no more paths). ``decode`` gives the text back; as in the library, U+2581 in a text comes back as a space.

Null texts count as empty; empty texts have one empty segmentation. Repeated rows with the same key get the same samples;
null keys share one stream. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import sliced

SPACE = "▁"
HEAD = 45.0
NODES, EDGES = 3_000_000, 7_000_000  # lattice kept in a worker; it starts anew beyond that (memory only, no effect on results)
ADD_CHARS = 30_000  # characters of new word units that are added at once (their work arrays stay in the processor's cache)
BATCH_BYTES = 250_000  # texts that are sampled in lockstep (or a single longer one)
NO_CHAR = 0x1FFFFF  # stands for U+0000, whose column the space mark has; no piece holds either
DENSE = 256  # code points below it have a column of their own in the trie (the space mark takes column 0)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(seed, *places) -> np.ndarray:
    """Seed of a place: each number is folded in turn."""
    x = np.atleast_1d(np.asarray(seed, np.uint64))
    for p in places:
        x = _mix(x + _STEP * np.atleast_1d(np.asarray(p + 1, np.uint64)))
    return x


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((_mix(x) >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53


def _truncated(phi: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel(phi) conditioned to lie below ``top``."""
    g = phi - np.log(-np.log(u))
    # exp(-G) = exp(-top) + exp(-g), the sum of the two exponential clocks
    return -np.logaddexp(-top, -g)


class Vocabulary:
    """Pieces of a model as a trie of sorted (state, character) keys."""

    def __init__(self, model: bytes, alpha: float = 1.0) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        self.text = [b""] * size
        self.byte_id = np.zeros(256, np.int32)
        plain = {}
        for n in range(size):
            piece = sp.id_to_piece(n)
            if sp.is_byte(n):
                self.byte_id[int(piece[3:5], 16)] = n
                self.text[n] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(n) or sp.is_unknown(n) or sp.is_unused(n)):
                plain[piece] = n
                self.text[n] = piece.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) for p in plain):
            raise ValueError("a piece holds a space mark after another character: word units would not be exact")
        self.length = np.array([len(t) for t in self.text], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.spelled = np.frombuffer(b"".join(self.text), np.uint8)
        self.weight = -alpha * np.log(np.arange(size) + 10.0)
        self.byte_weight = float(self.weight[-1])
        self.longest = max(map(len, plain))
        self.cuts = "".join(c for c in "\n\t\r" if not any(c in p for p in plain))
        self.cut_byte = np.isin(np.arange(256), [ord(c) for c in self.cuts])
        steps, accepts = {}, [-1]
        for piece, n in plain.items():
            state = 0
            for c in piece:
                key = (state << 21) | ord(c)
                if key not in steps:
                    steps[key] = len(accepts)
                    accepts.append(-1)
                state = steps[key]
            accepts[state] = n
        # characters below DENSE step through a table, others through sorted keys
        self.table = np.zeros((len(accepts), DENSE), np.uint16 if len(accepts) < 1 << 16 else np.int32)
        self.table[tuple(np.array([(k >> 21, self._column(k & 0x1FFFFF)) for k in steps if self._column(k & 0x1FFFFF) < DENSE]).T)] = [
            n for k, n in steps.items() if self._column(k & 0x1FFFFF) < DENSE]
        self.keys = np.array(sorted(steps), np.int64)
        self.to = np.array([steps[k] for k in self.keys.tolist()], np.int64)
        self.accepts = np.array(accepts, np.int64)
        cut = re.escape(self.cuts)
        self.units = re.compile(f"[{cut}]|{SPACE}*[^{SPACE}{cut}]+|{SPACE}+" if cut else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    @staticmethod
    def _column(c: int) -> int:
        return 0 if c == ord(SPACE) else c

    def step(self, state: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """Next trie states, 0 for none."""
        small = chars < DENSE
        out = self.table.ravel()[state * DENSE + np.where(small, chars, 1)].astype(np.int64)
        if not small.all():
            odd = np.flatnonzero(~small)
            key = (state[odd] << 21) | chars[odd]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[odd] = np.where(self.keys[place] == key, self.to[place], 0)
        return out

    def split(self, text: str) -> list[str]:
        """Word units; a space mark is put before the text, as the model was made."""
        return self.units.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def split_all(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """``split`` of many texts at once: the different units (UTF-8, marks as spaces), the place of
        every unit among them, and each text's number of units."""
        spelled = [(" " + t.replace(SPACE, " ")).encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        raw = np.frombuffer(b"".join(spelled), np.uint8)
        if not len(raw):  # no text has a unit
            return [], np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        upto = np.cumsum([0, *map(len, spelled)])
        space, cut = raw == ord(" "), self.cut_byte[raw]
        new = cut.copy()
        new[1:] |= cut[:-1] | (space[1:] & ~space[:-1])
        new[upto[:-1][np.diff(upto) > 0]] = True
        begin = np.flatnonzero(new)
        ends = pa.py_buffer(np.append(begin, len(raw)).astype(np.int32))
        units = pa.Array.from_buffers(pa.binary(), len(begin), [None, ends, pa.py_buffer(raw)]).dictionary_encode()
        _, ends, spelled = units.dictionary.buffers()
        ends, spelled = np.frombuffer(ends, np.int32)[:len(units.dictionary) + 1].tolist(), spelled.to_pybytes()
        different = [spelled[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return different, units.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(begin, upto))

    def ids(self, labels: np.ndarray) -> np.ndarray:
        """Piece ids of edge labels: an id, or -1 - code point for a character spelled in bytes."""
        odd = np.flatnonzero(labels < 0)
        if not len(odd):
            return labels.astype(np.int32)
        c = -1 - labels[odd]
        if c.max() < 0x80:
            out = labels.astype(np.int32)
            out[odd] = self.byte_id[c]
            return out
        n = np.ones(len(labels), np.int64)
        n[odd] = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        out = np.repeat(labels, n).astype(np.int32)
        begin = (np.cumsum(n) - n)[odd]
        for one in np.unique(c).tolist():
            spelled = self.byte_id[list(chr(one).encode("utf-8", "surrogatepass"))]
            out[begin[c == one][:, None] + np.arange(len(spelled))] = spelled
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decode_all([ids])[0]

    def decode_all(self, listed: list[np.ndarray]) -> list[bytes]:
        """Texts of many id lists, as one gather over the pieces' bytes; the mark before a text goes."""
        ids = np.concatenate(listed) if listed else np.zeros(0, np.int64)
        size = self.length[ids]
        upto = np.cumsum(size)
        flat = self.spelled[np.arange(upto[-1] if len(upto) else 0) + np.repeat(self.begin[ids] - (upto - size), size)].tobytes()
        ends = np.concatenate([[0], upto])[np.cumsum([0, *map(len, listed)])].tolist()
        return [flat[a + (flat[a:a + 1] == b" " and b > a):b] for a, b in zip(ends, ends[1:], strict=False)]


class Lattice:
    """Nodes and edges of remembered word units, with the share of each edge among the paths through its node."""

    def __init__(self, vocabulary: Vocabulary, nodes: int = NODES) -> None:
        self.v, self.nodes_kept, self.edges_kept = vocabulary, nodes, nodes * EDGES // NODES
        self._new(self.nodes_kept, self.edges_kept)

    def _new(self, nodes: int, edges: int) -> None:
        """Empty tables (touched only as far as they are filled). Node 0 is the end of every unit."""
        self.start: dict[bytes, int] = {}
        self.n_nodes, self.n_edges = 1, 0
        self.first = np.zeros(nodes + 2, np.int32)
        self.src, self.dst, self.label = np.zeros(edges, np.int32), np.zeros(edges, np.int32), np.zeros(edges, np.int32)
        self.share, self.cum = np.zeros(edges), np.zeros(edges)

    def nodes(self, units: list[bytes]) -> np.ndarray:
        """Start node of each unit; unknown ones are added, and the table starts anew when it is full."""
        found = np.fromiter(map(self.start.get, units, repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(found < 0)
        if not len(new):
            return found
        fresh = dict.fromkeys(map(units.__getitem__, new.tolist()))
        if not self._add_all(fresh):
            every = dict.fromkeys(units)
            size = sum(map(len, every))
            self._new(max(self.nodes_kept, size), max(self.edges_kept, size * self.v.longest))
            self._add_all(every)
            new = np.arange(len(units))
        found[new] = np.fromiter(map(self.start.__getitem__, map(units.__getitem__, new.tolist())), np.int64, len(new))
        return found

    def _add_all(self, units: Iterable[bytes]) -> bool:
        part, size = [], 0
        for u in units:
            part.append(u)
            size += len(u)
            if size >= ADD_CHARS:
                if not self._add(part):
                    return False
                part, size = [], 0
        return not part or self._add(part)

    def _add(self, units: list[bytes]) -> bool:
        v, spelled = self.v, b"".join(units)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        lengths = np.add.reduceat((np.frombuffer(spelled, np.uint8) & 0xC0) != 0x80, np.cumsum(sizes) - sizes, dtype=np.int64)
        chars = np.frombuffer(spelled.decode("utf-8", "surrogatepass").replace(" ", SPACE).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(chars))  # characters to the unit's end
        columns = np.where(chars == ord(SPACE), 0, np.where(chars == 0, NO_CHAR, chars))
        at, state = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        found = []  # a span's pieces: their places and labels
        degree = np.zeros(len(chars), np.int64)
        for span in range(1, v.longest + 1):
            ok = left[at] >= span
            at, state = at[ok], state[ok]
            state = v.step(state, columns[at + span - 1])
            hit = state > 0
            at, state = at[hit], state[hit]
            if not len(at) and span > 1:
                break
            label = v.accepts[state]
            got = label >= 0
            place, label = at[got], label[got]
            weight = v.weight[label]
            if span == 1:  # a character that is no piece is spelled in bytes
                lone = np.ones(len(chars), bool)
                lone[place] = False
                lone = np.flatnonzero(lone)
                c = chars[lone]
                place, label = np.concatenate([place, lone]), np.concatenate([label, -1 - c])
                weight = np.concatenate([weight, (1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)) * v.byte_weight])
            degree[place] += 1
            found.append((span, place, label, weight))
        size = sum(len(place) for _, place, _, _ in found)
        e, n = self.n_edges, self.n_nodes
        if n + len(chars) >= len(self.first) or e + size > len(self.dst):
            return False
        # nodes are numbered from the units' ends backwards, all units at a time, and masses are made in that order
        by = np.argsort(left.astype(np.uint16) if left.max() < 1 << 16 else left, kind="stable")
        number = np.empty(len(chars), np.int64)
        number[by] = np.arange(1, len(chars) + 1)
        degree = degree[by]
        first = np.cumsum(degree) - degree
        node, label, dst, weight = np.repeat(np.arange(1, len(chars) + 1), degree), np.empty(size, np.int64), np.zeros(size, np.int64), np.empty(size)
        free = np.empty(len(chars), np.int64)
        free[by] = first
        for span, place, some, heavy in reversed(found):  # longer pieces first: they are mostly the likelier ones
            to = free[place]
            free[place] = to + 1
            label[to], weight[to] = some, heavy
            inner = left[place] > span
            dst[to[inner]] = number[place[inner] + span]
        mass = np.zeros(len(chars) + 1)
        stops = np.searchsorted(left[by], np.arange(1, left.max() + 2))
        for a, b in zip(stops.tolist(), stops[1:].tolist(), strict=False):
            lo, hi = first[a], first[b - 1] + degree[b - 1]
            val = weight[lo:hi] + mass[dst[lo:hi]]
            opens = first[a:b] - lo
            high = np.maximum.reduceat(val, opens)
            mass[a + 1:b + 1] = high + np.log(np.add.reduceat(np.exp(val - np.repeat(high, degree[a:b])), opens))
        share = weight + mass[dst] - mass[node]
        p = np.exp(share)
        cum = np.cumsum(p)
        cum -= np.repeat((cum - p)[first], degree)
        cum[first + degree - 1] = 2.0
        self.dst[e:e + len(dst)] = np.where(dst == 0, 0, dst + (n - 1))
        self.src[e:e + len(dst)], self.label[e:e + len(dst)] = node + (n - 1), label
        self.share[e:e + len(dst)], self.cum[e:e + len(dst)] = share, cum
        self.first[n:n + len(chars)] = first + e
        self.first[n + len(chars)] = e + len(dst)
        self.start.update(zip(units, (number[np.cumsum(lengths) - lengths] + (n - 1)).tolist(), strict=True))
        self.n_edges, self.n_nodes = e + len(dst), n + len(chars)
        return True

    def draw(self, starts: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A path from each start node to the end of its unit, drawn by mass: edges in order and their counts."""
        live = np.flatnonzero(starts > 0)
        node, took, steps = starts[live], np.zeros(len(starts), np.int64), []
        seeds = seeds[live]
        while len(live):
            e = self.first[node].astype(np.int64)
            many = np.flatnonzero(self.first[node + 1] - e > 1)
            if len(many):
                u = _uniform(seeds[many] + _STEP * np.full(1, len(steps) + 1, np.uint64))
                em = e[many]
                more = np.flatnonzero(u > self.cum[em])
                high, at = u[more], em[more]
                while len(more):
                    at += 1
                    em[more] = at
                    left = np.flatnonzero(high > self.cum[at])
                    more, high, at = more[left], high[left], at[left]
                e[many] = em
            steps.append((live, e))
            took[live] = len(steps)
            node = self.dst[e]
            left = np.flatnonzero(node)
            live, node, seeds = live[left], node[left].astype(np.int64), seeds[left]
        begin = np.cumsum(took) - took
        out = np.zeros(int(took.sum()), np.int64)
        for n, (who, e) in enumerate(steps):
            out[begin[who] + n] = e
        return out, took


class Path:
    """A segmentation of one text: its edges, the unit of each, and what was drawn for it."""

    __slots__ = ("edges", "fixed", "perturbed", "sums", "unit")

    def __init__(self, edges, unit, perturbed, fixed, sums):
        self.edges, self.unit, self.perturbed, self.fixed, self.sums = edges, unit, perturbed, fixed, sums

    @property
    def log_prob(self) -> float:
        return float(self.sums[-1]) if len(self.sums) else 0.0


def _siblings(lat: Lattice, edges: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges passed by on the way along ``edges``: (position in ``edges``, edge, log-probability of the paths behind it).
    ``before`` is the log-probability of the beginning before each edge."""
    node = lat.src[edges]
    lo, hi = lat.first[node].astype(np.int64), lat.first[node + 1].astype(np.int64)
    n = hi - lo
    at = np.repeat(np.arange(len(edges)), n)
    edge = np.arange(len(at)) + np.repeat(lo - (np.cumsum(n) - n), n)
    other = edge != edges[at]
    at, edge = at[other], edge[other]
    return at, edge, before[at] + lat.share[edge]


def _open(lat: Lattice, noise: np.ndarray, later: np.ndarray, paths: list[Path], frontiers: list[list], k: int) -> None:
    """Frontier nodes beside new paths, one path a text: siblings in its head, and one node for all later ones. ``noise`` is
    each text's stream for the siblings, ``later`` the uniform number of its later node."""
    if not paths:
        return
    heads = [max(p.fixed, min(len(p.edges), int(np.searchsorted(-p.sums, HEAD)) + 1)) for p in paths]  # places with a likely enough beginning
    took = np.array([h - p.fixed for p, h in zip(paths, heads, strict=True)], np.int64)
    perturbed = np.array([p.perturbed for p in paths])
    text = np.repeat(np.arange(len(paths)), took)
    place = np.arange(len(text)) - np.repeat(np.cumsum(took) - took - np.array([p.fixed for p in paths], np.int64), took)
    before = np.concatenate([np.concatenate([[0.0], p.sums])[p.fixed:h] for p, h in zip(paths, heads, strict=True)])
    at, edge, phi = _siblings(lat, np.concatenate([p.edges[p.fixed:h] for p, h in zip(paths, heads, strict=True)]), before)
    text, place = text[at], place[at]
    ends = np.searchsorted(text, np.arange(len(paths) + 1))
    value = _truncated(phi, perturbed[text], _uniform(_stream(noise[text], np.arange(len(text)) - ends[text])))
    for n, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist(), strict=False)):
        # no more than k of them can be popped, and one bounds the rest
        best = np.argpartition(-value[a:b], k)[:k + 1] + a if b - a > k + 1 else np.arange(a, b)
        frontiers[n].extend(zip(value[best].tolist(), repeat(paths[n]), place[best].tolist(), edge[best].tolist(), strict=False))
    start = np.array([p.sums[h - 1] if h else 0.0 for p, h in zip(paths, heads, strict=True)])
    rest = np.array([p.log_prob for p in paths]) - start
    tail = np.flatnonzero((rest < -1e-12) & (np.array(heads) < [len(p.edges) for p in paths]))
    value = _truncated(start[tail] + np.log(-np.expm1(rest[tail])), perturbed[tail], later[tail])
    for n, x in zip(tail.tolist(), value.tolist(), strict=True):
        frontiers[n].append((x, paths[n], heads[n], -1))


def _open_later(lat: Lattice, seed: np.uint64, sample: int, value: float, path: Path, head: int, frontier: list) -> None:
    """The node of all later siblings was popped: one of them inherits its value, the others lie below."""
    at, edge, phi = _siblings(lat, path.edges[head:], np.concatenate([[0.0], path.sums])[head:-1])
    if not len(edge):
        return
    place = at + head
    u = _uniform(_stream(seed, 9, sample, np.arange(len(edge) + 1)))
    share = np.exp(phi - phi.max())
    heir = int(np.searchsorted(np.cumsum(share), u[-1] * share.sum()))
    below = _truncated(phi, value, u[:-1])
    below[heir] = value
    frontier.extend((float(x), path, int(p), int(e)) for x, p, e in zip(below, place, edge, strict=True))


def sample_batch(lat: Lattice, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to ``k`` distinct segmentations: (ids, log-probability, perturbed value, inclusion score)."""
    units, place_of, counts = lat.v.split_all(texts)
    begin = np.cumsum(counts) - counts
    starts = lat.nodes(units)[place_of]
    emitted: list[list[Path]] = [[] for _ in texts]
    frontier: list[list] = [[] for _ in texts]
    bound = [None] * len(texts)
    roots = -np.log(-np.log(_uniform(_stream(seeds, 1))))
    todo = [(n, None, 0, -1, float(roots[n])) for n in range(len(texts))]
    for sample in range(k):
        noise, later = _stream(seeds, 7, sample), _uniform(_stream(seeds, 8, sample, 0))
        # the rest of each new path, drawn for all texts in lockstep
        parts, owners, tails = [], [], []
        for n, path, place, edge, _ in todo:
            first_unit = int(path.unit[place]) + 1 if path is not None else 0
            rest = starts[begin[n] + first_unit:begin[n] + counts[n]]
            if path is not None:
                parts.append(np.array([lat.dst[edge]], np.int64))
                owners.append(np.array([first_unit - 1], np.int64))
                tails.append(n)
            parts.append(rest)
            owners.append(np.arange(first_unit, counts[n]))
            tails.append(n)
        nodes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        units = np.concatenate(owners) if owners else np.zeros(0, np.int64)
        text_of = np.repeat(np.array(tails, np.int64), [len(p) for p in parts]) if parts else np.zeros(0, np.int64)
        edges, took = lat.draw(nodes, _stream(seeds[text_of] if len(text_of) else np.zeros(0, np.uint64), 2, sample, units))
        edge_unit, edge_text = np.repeat(units, took), np.repeat(text_of, took)
        lo = np.searchsorted(edge_text, np.arange(len(texts)), side="left")
        hi = np.searchsorted(edge_text, np.arange(len(texts)), side="right")
        opened = []
        for n, path, place, edge, value in todo:
            mine, unit = edges[lo[n]:hi[n]], edge_unit[lo[n]:hi[n]]
            fixed = 0
            if path is not None:
                mine = np.concatenate([path.edges[:place], [edge], mine])
                unit = np.concatenate([path.unit[:place + 1], unit])
                fixed = place + 1
            emitted[n].append(Path(mine, unit, value, fixed, np.cumsum(lat.share[mine])))
            opened.append(n)
        _open(lat, noise[opened], later[opened], [emitted[n][-1] for n in opened], [frontier[n] for n in opened], k)
        todo = []
        for n in range(len(texts)):
            if len(emitted[n]) != sample + 1:
                continue
            got = None
            while frontier[n]:
                best = max(range(len(frontier[n])), key=lambda i, f=frontier[n]: f[i][0])
                got = frontier[n].pop(best)
                if got[3] >= 0:
                    break
                _open_later(lat, seeds[n], sample, got[0], got[1], got[2], frontier[n])
                got = None
            if got is not None:
                bound[n] = got[0]
                todo.append((n, got[1], got[2], got[3], got[0]))
            else:
                bound[n] = None
    out = []
    for n in range(len(texts)):
        rows = []
        for p in emitted[n]:
            chance = 1.0 if bound[n] is None or len(emitted[n]) < k else float(-np.expm1(-np.exp(p.log_prob - bound[n])))
            rows.append((lat.v.ids(lat.label[p.edges]), p.log_prob, p.perturbed, chance))
        out.append(rows)
    return out


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("sample", pa.int32()), ("ids", pa.list_(pa.int32())), ("n_pieces", pa.int64()),
                     ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64()), ("round_trip", pa.bool_())])
_COLUMNS = "sample int, ids array<int>, n_pieces long, log_prob double, perturbed double, inclusion double, round_trip boolean"


def _one_row(samples: pa.RecordBatch) -> pa.RecordBatch:
    """A row for each text: its first sample, with the later ones as ``others``."""
    sample = samples.column("sample").to_numpy()
    first, later = np.flatnonzero(sample == 0), samples.take(pa.array(np.flatnonzero(sample > 0)))
    ends = np.append(first - np.arange(len(first)), len(later)).astype(np.int32)
    others = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(later.columns[1:], fields=list(_SCHEMA)[1:]))
    return pa.RecordBatch.from_arrays([*samples.take(pa.array(first)).columns, others], names=[*_SCHEMA.names, "others"])


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def sample_segmentations(docs: DataFrame, k: int = 2, model_path: str | None = None, alpha: float = 0.3, seed: int = 42,
                         id_col: str = "doc_id", text_col: str = "text", one_row: bool = False,
                         nodes: int = NODES, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, sample (0 is the largest perturbed value), ids, n_pieces, log_prob, perturbed, inclusion, round_trip.

    With ``one_row`` each input row gives one row: its sample 0, and the later samples as an array of structs ``others``.
    ``nodes`` (lattice kept in a worker) and ``batch_bytes`` trade memory for time and change no result."""
    with open(model_path or default_model(), "rb") as f:  # half a MB, read on the driver and shipped
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat = Lattice(Vocabulary(shared.value, alpha), nodes)
        for batch in (part for whole in batches for part in sliced(whole, "text", batch_bytes)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys, seeds = batch.column("doc_id"), batch.column("seed").to_numpy(zero_copy_only=False).view(np.uint64)
            made = sample_batch(lat, texts, seeds, k)
            owner = np.repeat(np.arange(len(texts)), [len(rs) for rs in made])
            rows = [(j, *r) for rs in made for j, r in enumerate(rs)]
            ids = [r[1] for r in rows]
            wanted = [t.replace(SPACE, " ").encode("utf-8", "replace") for t in texts]
            whole = [got == wanted[n] for got, n in zip(lat.v.decode_all(ids), owner.tolist(), strict=True)]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
            cols = [keys.take(pa.array(owner)), pa.array([r[0] for r in rows], pa.int32()), lists, pa.array(np.diff(ends).astype(np.int64)),
                    *[pa.array([r[c] for r in rows], pa.float64()) for c in (2, 3, 4)], pa.array(whole, pa.bool_())]
            flat = pa.RecordBatch.from_arrays(cols, schema=_SCHEMA)
            yield _one_row(flat) if one_row else flat

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), F.lit(seed)).alias("seed"),
                       F.col(text_col).cast("string").alias("text"))
    others = ", others array<struct<" + _COLUMNS + ">>" if one_row else ""
    return rows.mapInArrow(run, f"doc_id long, {_COLUMNS}{others}")


def decode_ids(samples: DataFrame, model_path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """The same rows with ``decoded``, the text that the ids spell."""
    with open(model_path or default_model(), "rb") as f:
        shared = samples.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(shared.value)
        for batch in batches:
            texts = [v.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return samples.mapInArrow(run, StructType([*samples.schema.fields, StructField("decoded", StringType())]))
