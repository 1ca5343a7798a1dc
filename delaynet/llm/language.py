"""Language identification by cross-parsing.

Each language gets a suffix automaton of a bounded sample of its labelled text.
A text is parsed from left to right into the longest phrases that occur in the
sample; a language that fits needs few phrases. A phrase costs the bits that name
a place in the sample, so the cost per letter estimates the cross entropy, and
the cheapest language wins.

Each language has an alphabet of its own. Letters beyond its most frequent ones
share classes, and cost the bits that tell the letters of a class apart; a letter
that its sample does not hold is always a phrase.

The automata become one dense transition table whose missing transitions lead
back through the root, marked as the start of a phrase. Many texts are then parsed
in step, with array operations over all of them and all languages at once.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.llm.common import hash_order, map_batches, slices, texts_of

SAMPLE_ROWS = 240  # distinct labelled texts that a language is learned from, about
SAMPLE_LETTERS = 30_000  # symbols of each language's sample
MOST_LANGUAGES = 200  # labels that are learned, those with the most distinct texts first
SAMPLE_IN_ALL = 1_200_000  # symbols of all samples together, which bounds the model that goes to every worker
LONGEST = 20_000  # characters that are learned from at the start of a text
ALPHABET = 64  # symbols of a language: blank, letter it does not have, its most frequent letters, classes of others
LEAST = 64  # symbols of a text's slice, if there are more texts than the sample holds
CLASSES = 16  # of the letters that a language has beyond its most frequent ones
BLOCK = 2048  # symbols that are parsed as one sequence; a phrase ends with its block
SPARE_PHRASES = 3  # that any text may cost beyond its letters, as its first phrases are cut short
UNKNOWN = "und"

_BLANK, _RARE = 0, 1


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")


def alphabet_of(texts: list[str]) -> list[str]:
    """All letters of the texts."""
    return sorted(c for c in set().union(*(text.lower() for text in texts)) if c.isalpha())


def symbol_table(letters: list[str]) -> np.ndarray:
    """Symbol of each code point: blank for anything but letters, which come in runs of one."""
    table = _letters().astype(np.min_scalar_type(len(letters) + _RARE))  # letters start as the rare one
    for symbol, letter in enumerate(letters, start=_RARE + 1):
        table[ord(letter)] = symbol
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """The text as symbols, with each run of other characters as one blank and none at the ends."""
    found = table[code_points(text)]
    blank = found == _BLANK
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    kept = found[keep]
    if len(kept) and kept[0] == _BLANK:
        kept = kept[1:]
    return kept[:-1] if len(kept) and kept[-1] == _BLANK else kept


def own_symbols(sequence: np.ndarray, letters: list[str], size: int = ALPHABET) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each symbol of all `letters`: the one of `size` that a language with this sample has for it, and the bits
    that tell it from others of its class. Also how many letters the sample holds.

    Letters that the sample does not hold are the rare one, which then stands nowhere in it.
    """
    counted = np.bincount(sequence, minlength=len(letters) + 2)
    counted[[_BLANK, _RARE]] = 0
    ranked = np.argsort(-counted, kind="stable")[: np.count_nonzero(counted)]
    own, bits = np.full(len(counted), _RARE, dtype=np.int32), np.zeros(len(counted))
    own[_BLANK] = _BLANK
    classes = max(1, min(CLASSES, size // 4))
    first = ranked if len(ranked) <= size - 2 else ranked[: size - 2 - classes]
    own[first] = np.arange(2, 2 + len(first))
    others = ranked[len(first) :]
    group = np.array([ord(letters[symbol - 2]) % classes for symbol in others.tolist()], dtype=np.int64)
    own[others] = 2 + len(first) + group
    bits[others] = np.log2(np.bincount(group, minlength=classes))[group] if len(others) else 0.0
    return own, bits, len(ranked)


def suffix_automaton(sequence: np.ndarray, width: int) -> np.ndarray:
    """Transitions of the smallest automaton of all substrings; -1 where there is none."""
    none = array("i", [-1] * width)
    follow = array("i", none)
    longest, link, last = [0], [-1], 0
    for symbol in sequence.tolist():
        state = len(longest)
        longest.append(longest[last] + 1)
        link.append(0)
        follow.extend(none)
        at = last
        while at >= 0 and follow[at * width + symbol] < 0:
            follow[at * width + symbol] = state
            at = link[at]
        if at >= 0:
            reached = follow[at * width + symbol]
            if longest[reached] == longest[at] + 1:
                link[state] = reached
            else:
                clone = len(longest)
                longest.append(longest[at] + 1)
                link.append(link[reached])
                follow.extend(follow[reached * width : (reached + 1) * width])
                while at >= 0 and follow[at * width + symbol] == reached:
                    follow[at * width + symbol] = clone
                    at = link[at]
                link[reached] = link[state] = clone
        last = state
    return np.frombuffer(follow, dtype=np.int32).reshape(-1, width)


@dataclass(frozen=True)
class Model:
    """Automata of all languages in one table; `steps[state + own symbol]` is the next state.

    Texts come as symbols of the letters of all languages; `own` has those of each.
    """

    languages: list[str]
    letters: list[str]
    own: np.ndarray
    class_bits: np.ndarray  # that tell a symbol from others of its class, by language
    letter_bits: np.ndarray  # that name any symbol of a language on its own
    steps: np.ndarray
    roots: np.ndarray
    phrase_bits: np.ndarray

    def parse(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Phrases of each sequence under each language."""
        owner, starts, sizes, begin = [], [], [], 0
        for number, sequence in enumerate(sequences):
            for at in range(0, len(sequence), BLOCK):
                owner.append(number)
                starts.append(begin + at)
                sizes.append(min(BLOCK, len(sequence) - at))
            begin += len(sequence)
        counts = np.zeros((len(self.languages), len(sequences)), dtype=np.int64)
        if not starts:
            return counts
        flat = np.concatenate(sequences).astype(np.int32)
        order = np.argsort(-np.array(sizes), kind="stable")
        starts, sizes, owner = np.array(starts)[order], np.array(sizes)[order], np.array(owner)[order]
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # blocks longer than each step
        phrases = np.ones((len(self.languages), len(starts)), dtype=np.int32)  # the one that the end closes
        state = np.repeat(self.roots[:, None], len(starts), axis=1)
        unmarked = np.iinfo(self.steps.dtype).max
        for step in range(sizes[0]):
            n = active[step]
            reached = self.steps[state[:, :n] + self.own[:, flat[starts[:n] + step]]]
            phrases[:, :n] += reached < 0
            state[:, :n] = reached & unmarked
        for language, found in enumerate(phrases):
            counts[language] = np.bincount(owner, weights=found, minlength=len(sequences))
        return counts

    def bits(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Cost of each sequence under each language: of its phrases, and of telling letters of a class apart."""
        found = self.parse(sequences) * self.phrase_bits[:, None]
        for language in np.flatnonzero(self.class_bits.any(axis=1)):
            found[language] += [self.class_bits[language][sequence].sum() for sequence in sequences]
        return found


def train(samples: dict[str, list[str]], total: int = SAMPLE_LETTERS, alphabet: int = ALPHABET) -> Model:
    """Automata of the languages' samples, of at most `total` symbols each."""
    names = sorted(samples)
    letters = alphabet_of([text for name in names for text in samples[name]])
    table = symbol_table(letters)
    parts, owns, class_bits, letter_bits, roots, bits, size = [], [], [], [], [], [], 0
    for name in names:
        sequence = sample_of(samples[name], table, total)
        own, told, held = own_symbols(sequence, letters, alphabet)
        width = int(own.max()) + 1
        follow = suffix_automaton(own[sequence], width)
        parts.append(follow)
        owns.append(own)
        class_bits.append(told)
        letter_bits.append(np.log2(held + 2))
        roots.append(size)
        bits.append(np.log2(max(2, len(sequence))))
        size += follow.size
    kind = np.int32 if size < 2**31 else np.int64
    steps = np.empty(size, dtype=kind)
    for begin, follow in zip(roots, parts):
        from_root = np.where(follow[0] < 0, 0, follow[0])
        moved = np.where(follow < 0, from_root[None, :], follow).astype(kind) * follow.shape[1] + begin
        moved[follow < 0] |= np.iinfo(kind).min  # marks a transition that starts a phrase
        steps[begin : begin + follow.size] = moved.ravel()
    stacked = [np.array(part).reshape(len(names), len(letters) + 2) for part in (owns, class_bits)]
    return Model(names, letters, *stacked, np.array(letter_bits), steps, np.array(roots, dtype=kind), np.array(bits))


def sample_of(texts: list[str], table: np.ndarray, total: int) -> np.ndarray:
    """Equal slices of the distinct texts' symbols, a blank behind each, `total` together at most.

    What short texts leave goes to the longer ones. Slices begin at places spread evenly over the texts.
    """
    texts = list(dict.fromkeys(texts))[: max(1, total // LEAST)]
    pieces = [symbols(text, table) for text in texts]
    share, left = 0, total
    for at, size in enumerate(sorted(len(piece) + 1 for piece in pieces)):
        share = max(share, min(size, left // (len(pieces) - at)))
        left -= min(size, share)
    cut = []
    for at, piece in enumerate(pieces):
        begin = max(0, len(piece) + 1 - share) * at // len(pieces)
        cut += [piece[begin : begin + share - 1], np.array([_BLANK], table.dtype)]
    return np.concatenate(cut or [np.zeros(0, table.dtype)])[:total]


def learning_rows(doc_id: Column) -> Column:
    """Whether a row may be learned from: four of five documents, by the checksum of their id."""
    return F.crc32(doc_id.cast("string")) % 5 != 0


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang",
    sample_rows: int = SAMPLE_ROWS, total: int = SAMPLE_LETTERS, most_languages: int = MOST_LANGUAGES,
) -> Model:
    """Learn from about `sample_rows` distinct labelled texts of each language, of one longer than LONGEST from its start.

    Texts are counted per language first, copies once, then drawn by a fixed hash of
    the text at the rate that gives the wanted number. Copies are removed before the
    texts reach the driver, so neither they nor an id with many rows make it collect more.
    Of more than `most_languages` labels, those with the most distinct texts are learned,
    ties by name, and above SAMPLE_IN_ALL symbols together all samples are shorter.

    Null labels, null texts and null ids are not learned from, and an empty table gives
    a model without languages.
    """
    usable = docs.filter(learning_rows(F.col(doc_id)) & F.col(label).isNotNull() & F.col(text).isNotNull())
    usable = usable.select(
        F.col(label).cast("string").alias("label"), F.substring(text, 1, LONGEST).alias("text"), hash_order(text).alias("hash"),
    ).withColumn("draw", F.pmod("hash", F.lit(1_000_000)))
    texts = usable.groupBy("label").agg(F.approx_count_distinct("hash").alias("texts"))
    rates = texts.orderBy(F.col("texts").desc(), "label").limit(most_languages)
    rates = rates.select("label", F.ceil(F.lit(1_000_000.0) * sample_rows / F.greatest("texts", F.lit(1))).alias("rate"))
    drawn = usable.join(F.broadcast(rates), "label").filter("draw < rate")
    drawn = drawn.groupBy("label", "hash").agg(F.min("draw").alias("draw"), F.min("text").alias("text"))
    samples: dict[str, list[str]] = {}
    for row in sorted(drawn.collect(), key=lambda r: (r.draw, r.hash, r.text)):
        samples.setdefault(row.label, []).append(row.text)
    return train(samples, min(total, SAMPLE_IN_ALL // max(1, len(samples))))


_TABLES: dict[tuple, np.ndarray] = {}


def worker_table(letters: tuple[str, ...]) -> np.ndarray:
    if letters not in _TABLES:
        _TABLES.clear()
        _TABLES[letters] = symbol_table(list(letters))
    return _TABLES[letters]


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Language, score, bits per symbol, and symbols of each text."""
    table = worker_table(tuple(model.letters))
    sequences = [symbols(text or "", table) for text in texts]
    size = np.array([len(s) for s in sequences])
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), size
    bits = model.bits(sequences)
    best = bits.argmin(axis=0)  # ties go to the first name
    least = bits.min(axis=0)
    score = 1.0 / np.exp2(np.maximum(least - bits, -1000.0)).sum(axis=0)
    languages = [model.languages[i] if n else UNKNOWN for i, n in zip(best, size)]
    return languages, np.where(size > 0, score, 0.0), np.where(size > 0, least / np.maximum(size, 1), 0.0), size


def identify(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`doc_id, held_out, lang_pred, score, bits_per_symbol` of every row's whole text.

    `score` is the winner's share of 2^-bits over all languages. A text that is
    null or has no letters is `und` with score 0, as is any text if nothing was
    learned. Languages that cost the same go by name. `held_out` is false without an
    id. Rows that repeat an id or a text each give a row, texts of any length are parsed
    whole, and no documents give no rows. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch)
            for low, high in slices([len(t or "") for t in texts]):
                found, score, bits, _ = predict(shared.value, texts[low:high])
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(found, pa.string()), pa.array(score), pa.array(bits)],
                    names=["doc_id", "held_out", "lang_pred", "score", "bits_per_symbol"],
                )

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(~learning_rows(F.col(doc_id)), F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )
    return map_batches(rows, run, "doc_id bigint, held_out boolean, lang_pred string, score double, bits_per_symbol double")


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text some learned language describes.

    Rejected are texts without letters, and texts of any length whose cheapest parse
    without SPARE_PHRASES costs more than naming every symbol of that language on
    its own. With nothing learned all rows stay.
    """
    if not model.languages:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        limits = dict(zip(shared.value.languages, zip(shared.value.letter_bits, shared.value.phrase_bits)))
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for low, high in slices([len(t or "") for t in texts]):
                found, _, bits, size = predict(shared.value, texts[low:high])
                known = np.array([name != UNKNOWN for name in found])
                letter, phrase = np.array([limits.get(name, (0.0, 0.0)) for name in found]).T
                good = known & (bits * size <= letter * size + SPARE_PHRASES * phrase)
                yield batch.slice(low, high - low).filter(pa.array(good))

    return map_batches(docs, run, docs.schema)
