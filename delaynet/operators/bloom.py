"""Blocked Bloom filter: all bits of an item lie in one block of 512.

A filter is a relation of its blocks that are not empty, each as eight 64-bit words.
An item sets and asks bits of a single row of it, so a filter is probed with one join
whatever the number of its hash functions, and built by a hash aggregate of grouped
bit-ors: no task sends more rows than there are blocks, whatever was added. The price
is uneven blocks, which `sized` pays for with more bits: it takes the size from the
number of items and the wanted share of false positives. `check_load` refuses a
filter that holds too much for it.

Filters whose blocks come in a multiple of `LANES` are in lanes: an item has the same
lane in each of them, so rows go through any number of them in one shuffle by lane.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaynet.functions.hashing import hash_bucket, hash_int

BROADCAST_LIMIT_BYTES = 64 << 20
BLOCK_BITS = 512
WORD_BITS = 64
BLOCK_BYTES = 160  # of one block in a broadcast relation, about
ADDRESS_BITS = 9  # that name a bit of a block
ADDRESSES = 6  # that one hash gives
LANES = 4096
CO_PARTITION = ("spark.sql.requireAllClusterKeysForCoPartition", "false")  # partitions by lane serve a join by lane and block
LANE_BITS = LANES * BLOCK_BITS
PARTITION_BYTES = 16 << 20  # of all filters, in a task that asks them by lane
WORDS = [f"w{i}" for i in range(BLOCK_BITS // WORD_BITS)]
FILTER_DDL = ", ".join(["block BIGINT", *(f"{word} BIGINT" for word in WORDS)])
_MOST_HASHES = 24


def _load_rate(load: float, k_hashes: int) -> float:
    """False positives of a filter with so many items a block, which come to the blocks by chance."""

    def of_block(items: float) -> float:
        return (1.0 - (1.0 - 1.0 / BLOCK_BITS) ** (k_hashes * items)) ** k_hashes

    if load > BLOCK_BITS:  # blocks this full differ little, and the chance of none at all is no number any more
        return of_block(load)
    rate, chance = 0.0, math.exp(-load)
    for items in range(int(load + 12 * math.sqrt(load) + 40)):
        rate += chance * of_block(items)
        chance *= load / (items + 1)
    return rate


@cache
def shape(fp_rate: float) -> tuple[int, int]:
    """Bits an item, and hash functions, for the wanted rate of false positives."""
    if not 0 < fp_rate < 1:
        raise ValueError("a rate of false positives lies between 0 and 1")
    for per_item in range(1, BLOCK_BITS):
        rates = {k: _load_rate(BLOCK_BITS / per_item, k) for k in range(1, min(_MOST_HASHES, per_item) + 1)}
        k_hashes = min(rates, key=rates.get)
        if rates[k_hashes] <= fp_rate:
            return per_item, k_hashes
    raise ValueError(f"no block of {BLOCK_BITS} bits keeps to a rate of {fp_rate}")


def sized(items: int, fp_rate: float = 0.01) -> tuple[int, int]:
    """Bits and hash functions for so many items at the wanted rate of false positives."""
    per_item, k_hashes = shape(fp_rate)
    return max(1, -(-items * per_item // BLOCK_BITS)) * BLOCK_BITS, k_hashes


def sized_in_lanes(items: int, fp_rate: float = 0.01) -> tuple[int, int]:
    """As `sized`, with the next number of bits that makes whole lanes."""
    m_bits, k_hashes = sized(items, fp_rate)
    return -(-m_bits // LANE_BITS) * LANE_BITS, k_hashes


def expected_fp_rate(items: int, m_bits: int, k_hashes: int) -> float:
    return _load_rate(items / max(1, m_bits // BLOCK_BITS), k_hashes)


def check_load(items: int, m_bits: int, k_hashes: int, fp_rate: float) -> None:
    """Raise if so many items give clearly more false positives than wanted."""
    expected = expected_fp_rate(items, m_bits, k_hashes)
    if expected > 1.5 * fp_rate:
        raise ValueError(f"{items} items in {m_bits} bits: {expected:.3f} false positives expected, {fp_rate} wanted")


def _blocks(m_bits: int) -> int:
    return max(1, m_bits // BLOCK_BITS)


def _words_of(item: Column, k_hashes: int, method: str) -> dict[str, Column]:
    """The hashes that the addresses of an item are cut from; numbers for null items as well, whose block is null."""
    return {f"_hash{i}": F.coalesce(hash_int(item, i + 1, method), F.lit(0)) for i in range(-(-k_hashes // ADDRESSES))}


def _hashes(item: Column, m_bits: int, k_hashes: int, method: str) -> dict[str, Column]:
    """The block of an item, and the hashes that its addresses are cut from."""
    if m_bits <= 0 or k_hashes <= 0:
        raise ValueError("filters need at least one bit and one hash function")
    return {"_block": hash_bucket(item, 0, _blocks(m_bits), method)} | _words_of(item, k_hashes, method)


def _word(i: int) -> str:
    """The word of an address, from the columns of `_hashes`.

    Expressions over many addresses are SQL text: a filter's thousand terms are built with one call.
    """
    return f"cast(shiftright(_hash{i // ADDRESSES}, {ADDRESS_BITS * (i % ADDRESSES) + 6}) & {len(WORDS) - 1} as int)"


def _bit(i: int) -> str:
    """The bit of an address in its word."""
    return f"shiftleft(1L, cast(shiftright(_hash{i // ADDRESSES}, {ADDRESS_BITS * (i % ADDRESSES)}) & {WORD_BITS - 1} as int))"


def _bits(k_hashes: int) -> list[str]:
    """The word and the bit in it of each address.

    Columns of their own, as each mask asks for all of them: worked out anew for every
    word, the code of a filter with many hash functions is too long to be compiled.
    """
    return [f"{_word(i)} as _word{i}" for i in range(k_hashes)] + [f"{_bit(i)} as _bit{i}" for i in range(k_hashes)]


def _masks(k_hashes: int) -> list[str]:
    """Per word, the bits that an item sets in it, from the columns of `_bits`. `if` has shorter code than `case when`."""
    return [" | ".join(f"if(_word{i} = {word}, _bit{i}, 0L)" for i in range(k_hashes)) for word in range(len(WORDS))]


def positions(item: Column, m_bits: int, k_hashes: int, method: str = "xxhash64") -> list[Column]:
    """Numbers of the bits that an item sets, counted over all blocks."""
    hashes = list(_hashes(item, m_bits, k_hashes, method).values())
    return [
        hashes[0] * BLOCK_BITS + F.shiftright(hashes[1 + i // ADDRESSES], ADDRESS_BITS * (i % ADDRESSES)).bitwiseAND(BLOCK_BITS - 1)
        for i in range(k_hashes)
    ]


def _merged(blocks: DataFrame, *keys: str) -> DataFrame:
    return blocks.groupBy(*keys, "block").agg(*[F.bit_or(word).alias(word) for word in WORDS])


def build(rows: DataFrame, item: Column, m_bits: int, k_hashes: int, method: str = "xxhash64") -> DataFrame:
    """The blocks of a filter of all items; null items add nothing."""
    hashed = rows.select(*[column.alias(name) for name, column in _hashes(item, m_bits, k_hashes, method).items()])
    placed = hashed.filter("_block is not null").selectExpr("_block as block", *_bits(k_hashes))
    return _merged(placed.selectExpr("block", *[f"{mask} as {word}" for word, mask in zip(WORDS, _masks(k_hashes))]))


def merge(*filters: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One filter of what any of the filters, all of the same size, hold; separately for each value of `keys`."""
    merged = filters[0]
    for other in filters[1:]:
        merged = merged.unionByName(other)
    return _merged(merged, *keys)


def set_bits(filter_rows: DataFrame) -> DataFrame:
    """The filter as a relation of the numbers of its set bits."""
    words = filter_rows.select("block", F.posexplode(F.array(*WORDS)).alias("word", "bits"))
    offsets = words.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(WORD_BITS - 1))))
    bit = F.col("block") * BLOCK_BITS + F.col("word") * WORD_BITS + F.col("offset")
    return offsets.filter(F.getbit("bits", "offset") == 1).select(bit.alias("bit"))


def _holds(k_hashes: int, words: str = "_words") -> str:
    """Whether the words of its block, if there is one, hold all bits of an item."""
    return "coalesce({}, false)".format(" and ".join(f"get({words}, {_word(i)}) & {_bit(i)} <> 0" for i in range(k_hashes)))


def might_contain(
    rows: DataFrame, item: Column, filter_rows: DataFrame, m_bits: int, k_hashes: int, method: str = "xxhash64", name: str = "maybe_seen"
) -> DataFrame:
    """`rows` with a boolean column: false means certainly not added; a null item never was.

    One join by block, so rows are neither repeated nor regrouped. Small filters are
    broadcast and the rows then stay in place; larger ones are joined in a shuffle.
    """
    hashes = _hashes(item, m_bits, k_hashes, method)
    blocks = filter_rows.select(F.col("block").alias("_block"), F.array(*WORDS).alias("_words"))
    small = m_bits // BLOCK_BITS * BLOCK_BYTES <= BROADCAST_LIMIT_BYTES
    asked = rows.withColumns(hashes).join(F.broadcast(blocks) if small else blocks, "_block", "left")
    return asked.withColumn(name, F.expr(_holds(k_hashes))).select(*rows.columns, name)


def partitions(blocks: int, at_least: int) -> int:
    """Tasks among which so many blocks are dealt out by lane."""
    return max(at_least, -(-blocks * BLOCK_BYTES // PARTITION_BYTES))


def by_lane(filter_rows: DataFrame, tasks: int) -> DataFrame:
    """The blocks with their lane, in partitions by it."""
    return filter_rows.withColumn("_lane", F.pmod("block", F.lit(LANES))).repartition(tasks, "_lane")


def in_none(
    rows: DataFrame, item: Column, filters: list[tuple[DataFrame, int, int]], tasks: int, method: str = "xxhash64", folded: bool = False
) -> DataFrame:
    """Rows whose item certainly was added to none of the filters, each given with its bits and hash functions.

    All filters are in lanes. Each task holds only its own blocks, so no filter has to fit
    into a broadcast; with `CO_PARTITION` set, rows move once for all filters. A block may
    come in several parts, which are merged where they are asked, unless the filters are `folded`.
    """
    if any(m_bits % LANE_BITS for _, m_bits, _ in filters):
        raise ValueError(f"filters in lanes have a multiple of {LANE_BITS} bits")
    place = hash_int(item, 0, method)
    places = {f"_block{i}": F.pmod(place, F.lit(_blocks(m_bits))) for i, (_, m_bits, _) in enumerate(filters)}
    most = max((k_hashes for _, _, k_hashes in filters), default=1)
    asked = rows.withColumn("_lane", F.pmod(place, F.lit(LANES))).repartition(tasks, "_lane")
    asked = asked.withColumns(places | _words_of(item, most, method))
    for i, (filter_rows, _, _) in enumerate(filters):
        dealt = by_lane(filter_rows, tasks)
        dealt = dealt if folded else _merged(dealt, "_lane")
        blocks = dealt.select("_lane", F.col("block").alias(f"_block{i}"), F.array(*WORDS).alias(f"_words{i}"))
        asked = asked.join(blocks.hint("shuffle_hash"), ["_lane", f"_block{i}"], "left")
    unseen = [f"not {_holds(k_hashes, f'_words{i}')}" for i, (_, _, k_hashes) in enumerate(filters)]
    return asked.filter(" and ".join(unseen) or "true").select(*rows.columns)
