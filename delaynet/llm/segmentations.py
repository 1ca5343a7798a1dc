"""Sampled SentencePiece segmentations without replacement, and decoding.

A text's lattice of pieces falls apart into the lattices of its words, as no piece
crosses the start of a word. A segmentation weighs the product of its pieces'
weights, which fall with their rank in the vocabulary; `alpha` flattens them.

Gumbel top-k, top down: the best perturbed segmentation of a region is a plain
sample of it, with a Gumbel value by the region's mass. What is left of the region
is split by the first word that differs from the sample, and each part gets a Gumbel
value below the sample's. The next sample is drawn from the part with the greatest
value, and so on: a best-first search that opens no more parts than it emits samples,
all of them distinct. The greatest value that is left over bounds the emitted ones,
which gives each its inclusion probability.

Word lattices are built once per worker and word, many at a time, and texts are
sampled in step. Draws come from a hash of row key, sample and place, so they depend
on nothing else.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaynet.llm.common import map_batches, slices, texts_of
from delaynet.llm.vocabularies import SPACE, marked_words, sentence_piece

SAMPLES = 2
ALPHA = 0.5
CACHE_WORDS = 400_000  # words whose lattices a worker remembers; above, the half that is met most often
STEP = 300_000  # characters sampled in step

_BASE = np.uint64(0x100000001B3)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(key: np.ndarray) -> np.ndarray:
    """What `uniform` takes in place of a 64-bit key; made once for many draws."""
    return _mixed(key + np.uint64(0x9E3779B97F4A7C15))


def uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Draws in (0, 1) by seed and place."""
    bits = _mixed(seed ^ (place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return ((bits >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52


class Vocabulary:
    """Pieces and their beginnings by length and hash, with log weights; characters outside it fall back to bytes."""

    def __init__(self, model: str, alpha: float):
        library = sentence_piece(model)
        size = library.get_piece_size()
        self.size = size
        self.bytes: list[bytes] = [b""] * size
        beginnings: list[dict[int, int]] = []  # by length less one: hash, and the piece that ends there or -1
        self.byte_ids = np.zeros(256, dtype=np.uint32)
        self.weight = np.full(size, -np.inf)
        base, mask = int(_BASE), 2**64 - 1
        for number in range(size):
            piece = library.id_to_piece(number)
            if library.is_control(number) or library.is_unknown(number):
                continue
            if library.is_byte(number):
                self.byte_ids[int(piece[1:-1], 16)] = number
                self.bytes[number] = bytes([int(piece[1:-1], 16)])
                continue
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} crosses the start of a word, so words cannot be sampled one by one")
            self.bytes[number] = piece.replace(SPACE, " ").encode()
            self.weight[number] = -alpha * np.log(min(-library.get_score(number), size) + 2.0)
            hashed = 0
            for depth, character in enumerate(piece):
                hashed = (hashed * base + ord(character) + 1) & mask
                if depth == len(beginnings):
                    beginnings.append({})
                beginnings[depth].setdefault(hashed, -1)
            beginnings[len(piece) - 1][hashed] = number
        self.byte_weight = -alpha * np.log(size + 2.0)
        self.longest = len(beginnings)
        self.beginnings = []
        for found in beginnings:
            hashes = np.array(sorted(found), np.uint64)
            self.beginnings.append((hashes, np.array([found[h] for h in hashes.tolist()], np.int32)))

    def matches(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Word, place, length, piece and log weight of every piece that occurs in the words.

        Places drop out where what follows begins no piece any more. Characters
        without a piece of their own count as pieces from `size` on.
        """
        width = codes.shape[1]
        single = np.arange(width)[None, :] < lengths[:, None]  # places that no one-character piece covers yet
        row, place = np.nonzero(single)
        flat, left = row * width + place, lengths[row] - place
        letters, hashed = codes.ravel(), np.zeros(len(row), dtype=np.uint64)
        found = []
        for length, (known, numbers) in enumerate(self.beginnings, start=1):
            hashed = hashed * _BASE + letters[flat + (length - 1)] + np.uint64(1)
            at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
            hit = known[at] == hashed
            piece = np.where(hit, numbers[at], -1)
            whole = np.flatnonzero(piece >= 0)
            if length == 1:
                single.ravel()[flat[whole]] = False
            piece = piece[whole]
            found.append((row[whole], place[whole], np.full(len(whole), length), piece, self.weight[piece]))
            longer = np.flatnonzero(hit & (left > length))
            if not len(longer):
                break
            row, place, flat, left, hashed = row[longer], place[longer], flat[longer], left[longer], hashed[longer]
        row, place = np.nonzero(single)
        own = codes[row, place].astype(np.int64)
        size = 1 + (own >= 0x80).astype(int) + (own >= 0x800) + (own >= 0x10000)
        found.append((row, place, np.ones(len(row), int), (own + self.size).astype(np.int32), self.byte_weight * size))
        return tuple(map(np.concatenate, zip(*found)))

    def ids(self, codes: np.ndarray) -> np.ndarray:
        """Vocabulary ids of chosen pieces, with bytes for characters outside of it."""
        odd = np.flatnonzero(codes >= self.size)
        if not len(odd):
            return codes.astype("<u4")
        own = codes[odd].astype("<u4") - np.uint32(self.size)
        content = own.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        if len(content) == len(odd):  # a byte each
            out = codes.astype("<u4")
            out[odd] = self.byte_ids[np.frombuffer(content, np.uint8)]
            return out
        sizes = np.ones(len(codes), dtype=np.int64)
        sizes[odd] += (own >= 0x80).astype(int) + (own >= 0x800) + (own >= 0x10000)
        out = np.repeat(codes, sizes).astype("<u4")
        out[_ranges((np.cumsum(sizes) - sizes)[odd], sizes[odd])] = self.byte_ids[np.frombuffer(content, np.uint8)]
        return out


@cache
def vocabulary(model: str, alpha: float) -> Vocabulary:
    return Vocabulary(model, alpha)


class _Growing:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.kind = kind
        self.room = np.zeros(1 << 16, dtype=kind)
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.room):
            larger = np.empty(max(2 * len(self.room), self.size + len(values)), dtype=self.kind)
            larger[: self.size] = self.room[: self.size]
            self.room = larger
        self.room[self.size : self.size + len(values)] = values
        self.size += len(values)


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin there with those sizes, one range after the other."""
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)


class _Numbers(dict):
    """Numbers of words in the order in which they are met; `new` lists those that have no lattice yet."""

    def __init__(self, *known):
        super().__init__(*known)
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        number = self[unit] = len(self)
        self.new.append(unit)
        return number


class Lattices:
    """The lattices of the words that a worker has met.

    A word's nodes are its places, in a row; a node's edges are its pieces, the
    longest first, with the chance of each given the node. Word w starts at
    node `start[w]`; `stop[w]` is the node after its last place.
    """

    def __init__(self, words: Vocabulary):
        self.words = words
        self.clear()

    def clear(self) -> None:
        self.known = _Numbers()
        self.start, self.stop, self.used = _Growing(np.int64), _Growing(np.int64), _Growing(np.int64)
        self.first_edge = _Growing(np.int64)  # by node
        self.upto, self.length, self.piece, self.log = _Growing(np.float32), _Growing(np.int8), _Growing(np.int32), _Growing(np.float64)

    def number(self, units: list[str]) -> np.ndarray:
        """Word numbers of units; lattices of new ones are built."""
        known = self.known
        numbers = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
        if known.new:
            new, known.new = sorted(known.new, key=len), []
            for grown in (self.start, self.stop, self.used):
                grown.add(np.zeros(len(new), dtype=np.int64))
            lengths = list(map(len, new))
            at = 0
            while at < len(new):
                longest = lengths[min(bisect_right(lengths, lengths[at] + 3), len(new)) - 1]  # of words much alike
                end = min(bisect_right(lengths, longest), at + max(1, 32_768 // (longest + 1)))
                self._build(new[at:end])
                at = end
        self.used.room[: self.used.size] += np.bincount(numbers, minlength=self.used.size)
        return numbers

    def shrink(self, words: int) -> None:
        """Keep at most that many words, the ones met most often; numbers change."""
        often = self.used.room[: self.used.size]
        kept = np.flatnonzero(often > 1)
        if len(kept) > words:
            kept = np.sort(kept[np.argpartition(-often[kept], words)[:words]])
        names, old = list(self.known), self.__dict__.copy()
        start, stop = old["start"].room[kept], old["stop"].room[kept]
        self.clear()
        if not len(kept):
            return
        node = _ranges(start, stop - start)
        last = np.r_[old["first_edge"].room[: old["first_edge"].size], old["upto"].size]
        count = last[node + 1] - last[node]
        edge = _ranges(last[node], count)
        ends = np.cumsum(stop - start)
        self.known = _Numbers((names[word], number) for number, word in enumerate(kept.tolist()))
        self.start.add(ends - (stop - start))
        self.stop.add(ends)
        self.used.add(often[kept] // 2)
        self.first_edge.add(np.cumsum(count) - count)
        for name in ("upto", "length", "piece", "log"):
            getattr(self, name).add(old[name].room[edge])

    def _build(self, units: list[str]) -> None:
        words = self.words
        texts = [SPACE + unit.replace(" ", SPACE) for unit in units]
        lengths = np.array(list(map(len, texts)))
        width = int(lengths.max())
        padded = "".join(text.ljust(width, "\0") for text in texts)
        codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(texts), width).astype(np.uint64)
        row, place, length, piece, weight = words.matches(codes, lengths)
        # by place and word, the longest first, as these tend to be likelier
        order = np.argsort((place * len(texts) + row) * (words.longest + 1) - length)
        row, place, length, piece, weight = row[order], place[order], length[order], piece[order], weight[order]
        cell = place * len(texts) + row
        begin = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])  # of each node's edges
        count = np.diff(np.r_[begin, len(cell)])
        nodes = np.searchsorted(place[begin], np.arange(width + 1))
        after = np.zeros((width + 1, len(texts)))  # log mass from each place to the end of the word, 0 at the end
        log = np.zeros(len(cell))
        for at in range(width - 1, -1, -1):
            mine = slice(nodes[at], nodes[at + 1])
            starts, sizes = begin[mine], count[mine]
            low, high = starts[0], starts[-1] + sizes[-1]
            paths = weight[low:high] + after[at + length[low:high], row[low:high]]
            top = np.maximum.reduceat(paths, starts - low)
            total = top + np.log(np.add.reduceat(np.exp(paths - np.repeat(top, sizes)), starts - low))
            after[at, row[starts]] = total
            log[low:high] = paths - np.repeat(total, sizes)
        # from there to the order of nodes, word by word
        ends = np.cumsum(lengths)
        node = (ends - lengths)[row[begin]] + place[begin]
        sizes = np.zeros(len(node), dtype=np.int64)
        sizes[node] = count
        firsts = np.cumsum(sizes) - sizes
        target = _ranges(firsts[node], count)
        log[target], length[target], piece[target] = log.copy(), length.copy(), piece.copy()
        begin, count = firsts, sizes
        upto = np.exp(log)
        for step in range(1, int(count.max())):
            later = begin[count > step] + step
            upto[later] += upto[later - 1]
        upto[begin + count - 1] = 2.0  # the last edge takes the rest
        log[begin[count == 1]] = 0.0
        first, edge = self.first_edge.size, self.upto.size
        number = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        self.start.room[number] = first + ends - lengths
        self.stop.room[number] = first + ends
        self.first_edge.add(edge + begin)
        self.upto.add(upto)
        self.length.add(length)
        self.piece.add(piece)
        self.log.add(log)

    def sample(self, word: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One segmentation of each word: pieces in a row, their number, and the log chance."""
        start, stop = self.start.room, self.stop.room
        node, end = start[word], stop[word]
        log = np.zeros(len(word))
        taken = []
        active, place = np.arange(len(word)), place << np.int64(20)
        while len(active):
            draw = uniform(key, place)
            edge = self.first_edge.room[node]
            late = np.flatnonzero(draw >= self.upto.room[edge])
            while len(late):
                after = edge[late] + 1
                edge[late] = after
                late = late[draw[late] >= self.upto.room[after]]
            taken.append((active, self.piece.room[edge]))
            log[active] += self.log.room[edge]
            node = node + self.length.room[edge]
            on = np.flatnonzero(node < end)
            active, node, end, key, place = active[on], node[on], end[on], key[on], place[on] + 1
        size = np.zeros(len(word), dtype=np.int64)
        for depth, (owner, _) in enumerate(taken, start=1):
            size[owner] = depth
        first = np.cumsum(size) - size
        pieces = np.empty(int(size.sum()), dtype=np.int32)
        for depth, (owner, piece) in enumerate(taken):
            pieces[first[owner] + depth] = piece
        return pieces, size, log

    def edges(self, node: int) -> range:
        last = self.first_edge.room[node + 1] if node + 1 < self.first_edge.size else self.upto.size
        return range(int(self.first_edge.room[node]), int(last))

    def path_edges(self, word: int, pieces: tuple[int, ...]) -> list[int]:
        node, out = int(self.start.room[word]), []
        for piece in pieces:
            edge = next(e for e in self.edges(node) if self.piece.room[e] == piece)
            out.append(edge)
            node += int(self.length.room[edge])
        return out

    def sample_other(self, word: int, excluded: list[tuple[int, ...]], key: np.uint64, place: int) -> tuple[list[int], float]:
        """A segmentation of the word that is none of the excluded ones, and its log chance among all."""
        barred = [self.path_edges(word, pieces) for pieces in excluded]
        node, end = int(self.start.room[word]), int(self.stop.room[word])
        pieces, log = [], 0.0
        draws = uniform(key, (place << 20) + (1 << 19) + np.arange(end - node)).tolist()
        for depth, draw in enumerate(draws):
            options = self.edges(node)
            logs = self.log.room[options.start : options.stop]
            mass = np.exp(logs).tolist()
            for at, edge in enumerate(options):
                paths = [path[depth + 1 :] for path in barred if path[depth] == edge]
                if paths:
                    mass[at] *= max(0.0, 1.0 - sum(float(np.exp(sum(self.log.room[e] for e in path))) for path in paths))
            upto = list(accumulate(mass))
            at = min(bisect_right(upto, draw * upto[-1]), len(upto) - 1)
            edge = options[at]
            pieces.append(int(self.piece.room[edge]))
            log += float(logs[at])
            node += int(self.length.room[edge])
            if node >= end:
                break
            barred = [path for path in barred if path[depth] == edge]
        return pieces, log


@cache
def lattices(model: str, alpha: float) -> Lattices:
    """The worker's own lattices."""
    return Lattices(vocabulary(model, alpha))


_LEAST = 1e-12  # a part of a region with less of its word's mass cannot be told from an empty one


class _Part:
    """What is left around one sample of a text: a Gumbel value per word, from `begin` on, that could differ first."""

    def __init__(self, begin, pieces, sizes, logs, values, barred):
        self.begin, self.pieces, self.sizes, self.logs, self.values, self.barred = begin, pieces, sizes, logs, values, barred
        self.settle()

    def settle(self) -> None:
        self.best = int(self.values.argmax()) if len(self.values) else -1
        self.top = float(self.values[self.best]) if self.best >= 0 else -np.inf

    def close(self) -> int:
        """The word where the best part differs; that part is taken."""
        at = self.begin + self.best
        self.values[self.best] = -np.inf
        self.settle()
        return at


def _gumbels(mass: np.ndarray, rest: np.ndarray, key: np.ndarray, place: np.ndarray, cap: np.ndarray) -> np.ndarray:
    """Gumbel values below `cap` of parts whose log mass is `mass` and the log of the share `rest`."""
    with np.errstate(divide="ignore"):
        mass = mass + np.log(np.where(rest > _LEAST, rest, 0.0))
        free = mass - np.log(-np.log(uniform(key, place + (np.int64(1) << 40))))
    return np.where(np.isfinite(mass), -np.logaddexp(-cap, -free), -np.inf)


def top_samples(store: Lattices, texts: list[list[str]], keys: np.ndarray, samples: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text's words, up to `samples` distinct segmentations, the greatest perturbed value first.

    Each is pieces, log chance, perturbed value, and the chance of its inclusion
    given the greatest value left over.
    """
    counts = np.array([len(words) for words in texts])
    numbers = store.number([word for words in texts for word in words])
    bounds = np.r_[0, np.cumsum(counts)]

    def drawn(owners: np.ndarray, begins: np.ndarray, prefix: np.ndarray, caps: np.ndarray, key: np.ndarray):
        """Fresh segmentations of the words from `begins` on, and the values of the parts around them; by owner."""
        sizes = counts[owners] - begins
        first = np.cumsum(sizes) - sizes
        place = np.arange(sizes.sum()) - np.repeat(first - begins, sizes)
        word = numbers[np.repeat(bounds[owners], sizes) + place]
        key = np.repeat(key, sizes)
        pieces, lengths, logs = store.sample(word, key, place)
        total, spans = np.zeros(len(logs)), list(zip(first.tolist(), (first + sizes).tolist()))
        for low, high in spans:  # one by one, so that no text changes another one's sums
            np.cumsum(logs[low:high], out=total[low:high])
        mass = total - logs + np.repeat(prefix, sizes)
        values = _gumbels(mass, -np.expm1(logs), key, place, np.repeat(caps, sizes))
        tokens = np.r_[0, np.cumsum(lengths)]
        for low, high in spans:
            chance = float(total[high - 1]) if high > low else 0.0
            yield pieces[tokens[low] : tokens[high]], lengths[low:high], logs[low:high], values[low:high].copy(), chance

    everyone = np.arange(len(texts))
    key = _round_seed(keys, 0)
    tops = -np.log(-np.log(uniform(key, np.full(len(texts), np.int64(1) << 41))))
    parts: list[list[_Part]] = []
    emitted: list[list[tuple]] = []
    nothing = np.zeros(len(texts))
    for owner, (pieces, sizes, logs, values, chance) in enumerate(drawn(everyone, nothing.astype(int), nothing, tops, key)):
        parts.append([_Part(0, pieces, sizes, logs, values, [])])
        emitted.append([(pieces, chance, float(tops[owner]))])
    for round_ in range(1, samples):
        key = _round_seed(keys, round_)
        chosen = []
        for owner in everyone.tolist():
            part = max(parts[owner], key=lambda part: part.top)
            value = part.top
            if not np.isfinite(value):
                continue
            at = part.close()
            low = int(part.sizes[:at].sum())
            own = tuple(part.pieces[low : low + int(part.sizes[at])].tolist())
            barred = [(own, float(part.logs[at])), *(part.barred if at == part.begin else [])]
            pieces, log = store.sample_other(int(numbers[bounds[owner] + at]), [p for p, _ in barred], key[owner], at)
            barred.append((tuple(pieces), log))
            chosen.append((owner, part, at, low, value, barred, pieces, log, float(part.logs[:at].sum())))
        if not chosen:
            break
        owners, ats, values, logs, prefixes = (np.array([c[i] for c in chosen]) for i in (0, 2, 4, 7, 8))
        rest = 1.0 - np.array([sum(np.exp(log) for _, log in c[5]) for c in chosen])
        firsts = _gumbels(prefixes, rest, key[owners], ats, values)
        tails = drawn(owners, ats + 1, prefixes + logs, values, key[owners])
        for (owner, part, at, low, value, barred, pieces, log, prefix), first, (tail, sizes, more, tail_values, chance) in zip(chosen, firsts, tails):
            whole = np.concatenate([part.pieces[:low], np.array(pieces, np.int32), tail])
            sizes = np.concatenate([part.sizes[:at], [len(pieces)], sizes])
            more = np.concatenate([part.logs[:at], [log], more])
            # The sample itself is barred at its first word only through its own part.
            parts[owner].append(_Part(at, whole, sizes, more, np.r_[first, tail_values], barred[:-1]))
            emitted[owner].append((whole, prefix + log + chance, value))
    out = []
    for found, left in zip(emitted, parts):
        bound = max(part.top for part in left)
        out.append([(p, log, value, float(-np.expm1(-np.exp(min(log - bound, 700.0))))) for p, log, value in found])
    return out


def _round_seed(keys: np.ndarray, round_: int) -> np.ndarray:
    return seeded(_mixed(keys + np.uint64(round_ * 0xA0761D6478BD642F % 2**64)))


_OUT = "doc_id bigint, sample int, n_tokens bigint, log_prob double, perturbed double, inclusion double, ids binary"
_NAMES = [column.split()[0] for column in _OUT.split(", ")]
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary()]


class Decoder:
    """Bytes of pieces, taken for many ids at once."""

    STEP = 200_000  # ids taken at a time

    def __init__(self, pieces: list[bytes]):
        self.pieces = np.array(pieces, dtype=object)

    def text(self, ids: np.ndarray) -> str:
        """The text that ids stand for, without the mark that starts it; broken UTF-8 is mended."""
        steps = (self.pieces[ids[at : at + self.STEP]].tolist() for at in range(0, len(ids), self.STEP))
        return b"".join(map(b"".join, steps))[1:].decode("utf-8", "replace")


@cache
def decoder(model: str) -> Decoder:
    """The worker's own decoder."""
    return Decoder(vocabulary(model, ALPHA).bytes)


def sampled(
    docs: DataFrame, model: str, samples: int = SAMPLES, alpha: float = ALPHA, seed: int = 0, doc_id: str = "doc_id", text: str = "text",
    decode: bool = False,
) -> DataFrame:
    """`doc_id, sample, n_tokens, log_prob, perturbed, inclusion, ids`: distinct segmentations of every whole text.

    `ids` are little-endian 32-bit vocabulary ids. A text with fewer segmentations
    than `samples` gets all it has; null and empty texts have the empty one. Rows
    that repeat a doc_id and text get the same samples. Other columns are not read.
    With `decode` a column `decoded` holds the text that the ids stand for.
    """

    names, kinds = (_NAMES + ["decoded"], _KINDS + [pa.string()]) if decode else (_NAMES, _KINDS)

    def run(batches):
        store, letters = lattices(model, alpha), decoder(model)
        for batch in batches:
            texts = [content or "" for content in texts_of(batch)]
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_numpy().view(np.uint64)
            for low, high in slices(list(map(len, texts)), STEP):
                if len(store.known) > CACHE_WORDS:
                    store.shrink(CACHE_WORDS // 2)
                found = top_samples(store, list(map(marked_words, texts[low:high])), keys[low:high], samples)
                rows = []
                for key, those in zip(ids[low:high], found):
                    for number, (pieces, log, value, chance) in enumerate(those, start=1):
                        content = store.words.ids(pieces)
                        back = (letters.text(content),) if decode else ()
                        rows.append((key, number, len(content), log, value, chance, content.tobytes(), *back))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.xxhash64(F.lit(seed), F.col(doc_id).cast("bigint")).alias("key"),
    )
    return map_batches(rows, run, _OUT + ", decoded string" * decode)


def decoded(rows: DataFrame, model: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the text that their ids stand for; null for null ids, and mending broken UTF-8."""
    schema = T.StructType([*rows.schema.fields, T.StructField(to, T.StringType())])
    at = rows.columns.index(ids)

    def run(batches):
        letters = decoder(model)
        for batch in batches:
            texts = []
            for content in batch.column(at).to_pylist():
                if content is None:
                    texts.append(None)
                    continue
                texts.append(letters.text(np.frombuffer(content, "<u4")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, to])

    return map_batches(rows, run, schema)
