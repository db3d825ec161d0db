"""Seating of a hierarchical Pitman-Yor model of words after words.

A dish is a word (its hash without the last byte). Customers of a word sit in the restaurant of the word
before them, of which there are as many as words (`Seats`). Every table there sends one customer to the
restaurant of the class of the word before, every table of a class one to the parent it shares with other
classes, and every table of a parent one to the root, where each known word has one table (`Shard`): the
base measure is spread over all possible words, so unknown words share what the root keeps for new tables.

A sweep seats all customers of a word anew in every restaurant by the Chinese restaurant process, given
the tables of all other words after the sweep before. Words are thus independent of each other within a
sweep, and shards of them only need the totals of each restaurant.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np

from ledgerloom.llm.textbytes import mixed

CONTEXTS, PARENTS = 256, 16
PER_PARENT = CONTEXTS // PARENTS
STRENGTH = 1.0
ONE_BY_ONE = 32


class Totals(NamedTuple):
    """Over all words: customers and tables by context and by parent, customers and words at the root."""

    customers: np.ndarray
    tables: np.ndarray
    parent_customers: np.ndarray
    parent_tables: np.ndarray
    root: np.ndarray  # customers, words
    ones_twos: np.ndarray  # dishes with one and with two customers: contexts, parents, root

    def flat(self) -> np.ndarray:
        return np.concatenate(self)

    @classmethod
    def of(cls, flat: np.ndarray) -> Totals:
        return cls(*np.split(flat, np.cumsum([CONTEXTS, CONTEXTS, PARENTS, PARENTS, 2])))

    @property
    def discounts(self) -> np.ndarray:
        """By level, from the numbers of dishes served once and twice."""
        ones, twos = self.ones_twos[0::2], self.ones_twos[1::2]
        return np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.05, 0.95)

    def root_new(self) -> float:
        """Probability of an unknown word at the root."""
        return (STRENGTH + self.discounts[2] * self.root[1]) / (self.root[0] + STRENGTH)

    def parent_new(self) -> np.ndarray:
        """What each parent passes on to the root."""
        return (STRENGTH + self.discounts[1] * self.parent_tables) / (self.parent_customers + STRENGTH)

    def context_new(self) -> np.ndarray:
        """What each context passes on to its parent."""
        return (STRENGTH + self.discounts[0] * self.tables) / (self.customers + STRENGTH)

    def unknown(self) -> np.ndarray:
        """Probability of an unknown word by context."""
        return self.context_new() * np.repeat(self.parent_new(), PER_PARENT) * self.root_new()


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, random: np.random.Generator) -> np.ndarray:
    """Tables that the customers of each dish take; `weight` is that of a new table for the dish.

    The first ONE_BY_ONE customers come one by one. After them each lot is as many as came before, and the
    chance in the middle of a lot stands for all of it.
    """
    tables = np.ones(len(customers), np.int64)
    active = np.flatnonzero(customers > 1)
    come = 1
    while len(active):
        lot = 1 if come < ONE_BY_ONE else come
        arriving = np.minimum(customers[active] - come, lot)
        chance = weight[active] / (weight[active] + come + (arriving - 1) / 2 - discount * tables[active])
        chance = np.clip(chance, 0.0, 1.0)
        tables[active] += random.random(len(active)) < chance if lot == 1 else random.binomial(arriving, chance)
        come += lot
        active = active[customers[active] > come]
    return tables


class Found(NamedTuple):
    """Where each of some keys is among the words, (word, parent) pairs and entries of a shard, and whether it is."""

    word: np.ndarray
    known: np.ndarray
    pair: np.ndarray
    met: np.ndarray
    entry: np.ndarray
    seen: np.ndarray


@dataclass
class Shard:
    """The customers of some words: keys (hash above, context in the last byte) in order, and counts."""

    keys: np.ndarray
    customers: np.ndarray

    def __post_init__(self):
        dishes = self.keys >> np.uint64(8)
        self.words, self.word = np.unique(dishes, return_inverse=True)
        self.context = (self.keys & np.uint64(255)).astype(np.int64)
        pairs = self.word * PARENTS + self.context // PER_PARENT
        self.pairs, self.pair = np.unique(pairs, return_inverse=True)
        self.parent, self.pair_word = self.pairs % PARENTS, self.pairs // PARENTS
        self.tables = np.ones(len(self.keys), np.int64)
        self.parent_tables = np.ones(len(self.pairs), np.int64)
        self.word_counts = np.bincount(self.word, self.customers, len(self.words)).astype(np.int64)

    @property
    def parent_customers(self) -> np.ndarray:
        return np.bincount(self.pair, self.tables, len(self.pairs)).astype(np.int64)

    @property
    def root_customers(self) -> np.ndarray:
        return np.bincount(self.pair_word, self.parent_tables, len(self.words)).astype(np.int64)

    def totals(self) -> Totals:
        root = self.root_customers
        levels = (self.customers, self.parent_customers, root)
        return Totals(
            np.bincount(self.context, self.customers, CONTEXTS).astype(float),
            np.bincount(self.context, self.tables, CONTEXTS).astype(float),
            np.bincount(self.parent, levels[1], PARENTS).astype(float),
            np.bincount(self.parent, self.parent_tables, PARENTS).astype(float),
            np.array([root.sum(), len(root)], float),
            np.array([(level == n).sum() for level in levels for n in (1, 2)], float),
        )

    def predictive(self, totals: Totals) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of words at the root, of (word, parent) and of (word, context) that occur."""
        discounts = totals.discounts
        root = (self.root_customers - discounts[2]) / (totals.root[0] + STRENGTH)
        served = self.parent_customers - discounts[1] * self.parent_tables
        parent = served / (totals.parent_customers[self.parent] + STRENGTH)
        parent += totals.parent_new()[self.parent] * root[self.pair_word]
        own = (self.customers - discounts[0] * self.tables) / (totals.customers[self.context] + STRENGTH)
        return root, parent, own + totals.context_new()[self.context] * parent[self.pair]

    def sweep(self, totals: Totals, random: np.random.Generator, customers: np.ndarray | None = None) -> None:
        """Seat everybody, or other customers of the same dishes, anew, given the totals of the sweep before."""
        discounts = totals.discounts
        root, parent, _ = self.predictive(totals)
        self.customers = self.customers if customers is None else customers
        weight = (STRENGTH + discounts[0] * totals.tables[self.context]) * parent[self.pair]
        tables = seat(self.customers, weight, discounts[0], random)
        weight = (STRENGTH + discounts[1] * totals.parent_tables[self.parent]) * root[self.pair_word]
        self.tables = tables
        self.parent_tables = seat(self.parent_customers, weight, discounts[1], random)

    def find(self, keys: np.ndarray) -> Found:
        above = (keys & np.uint64(255)).astype(np.int64) // PER_PARENT
        word, known = _find(self.words, keys >> np.uint64(8))
        return Found(word, known, *_find(self.pairs, word * PARENTS + above), *_find(self.keys, keys))

    def probabilities(self, keys: np.ndarray, totals: Totals, found: Found | None = None) -> np.ndarray:
        """Of any keys whose words belong to this shard, under the present seating."""
        at = found or self.find(keys)
        root, parent, own = self.predictive(totals)
        context = (keys & np.uint64(255)).astype(np.int64)
        above = context // PER_PARENT
        result = np.where(at.known, root[at.word], totals.root_new()) if len(root) else np.full(len(keys), totals.root_new())
        passed = totals.parent_new()[above] * result
        result = np.where(at.known & at.met, parent[at.pair], passed) if len(parent) else passed
        passed = totals.context_new()[context] * result
        return np.where(at.seen, own[at.entry], passed) if len(own) else passed

    def counts_of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        place, known = _find(self.words, words)
        return np.where(known, self.word_counts[place], 0)


def discount(ones: float, twos: float) -> float:
    """Of real contexts, from the numbers of their dishes served once and twice."""
    return float(np.clip(ones / max(ones + 2 * twos, 1), 0.05, 0.95))


def places(keys: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Of real contexts, spread evenly: the class in the last byte of the keys and 32 bits of the word before."""
    return mixed((keys & np.uint64(255)) << np.uint64(32) | before.astype(np.uint64))


@dataclass
class Seats:
    """The customers of some words after real words, over the Shard of the words after classes.

    Entries are in order of their keys (as of Shard) and of the words before (32 bits of their hash).
    """

    keys: np.ndarray
    before: np.ndarray
    customers: np.ndarray

    def __post_init__(self):
        new = np.diff(self.keys, prepend=~self.keys[:1]) != 0
        distinct, self.entry = self.keys[new], np.cumsum(new) - 1
        self.places = places(self.keys, self.before)
        self.tables = np.ones(len(self.keys), np.int64)
        self.shard = Shard(distinct, np.bincount(self.entry, minlength=len(distinct)).astype(np.int64))
        word = self.shard.word[self.entry]
        # counts of tokens, not of tables
        self.shard.word_counts = np.bincount(word, self.customers, len(self.shard.words)).astype(np.int64)

    def find(self, keys: np.ndarray, before: np.ndarray) -> tuple[Found, np.ndarray, np.ndarray]:
        """Where each pair is in the shard and among the entries, and whether it is there."""
        found = self.shard.find(keys)
        own = self.entry.astype(np.uint64) << np.uint64(32) | self.before
        place, there = _find(own, found.entry.astype(np.uint64) << np.uint64(32) | before)
        return found, place, there & found.seen

    def state(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.tables, self.shard.tables, self.shard.parent_tables

    def take(self, tables: np.ndarray, class_tables: np.ndarray, parent_tables: np.ndarray) -> None:
        """Go to a state."""
        self.tables, self.shard.tables, self.shard.parent_tables = tables, class_tables, parent_tables
        self.shard.customers = self._sent(tables)

    def _sent(self, tables: np.ndarray) -> np.ndarray:
        return np.bincount(self.entry, tables, len(self.shard.keys)).astype(np.int64)

    def sweep(self, totals: Totals, own: float, tables: np.ndarray, random: np.random.Generator) -> None:
        """Seat everybody anew, given the totals of the sweep before and all tables of the context of each entry."""
        chance = self.shard.predictive(totals)[2]
        weight = (STRENGTH + own * tables) * chance[self.entry]
        self.tables = seat(self.customers, weight, own, random)
        self.shard.sweep(totals, random, self._sent(self.tables))

    def probabilities(
        self,
        keys: np.ndarray,
        before: np.ndarray,
        totals: Totals,
        own: float,
        customers: np.ndarray,
        tables: np.ndarray,
        found: tuple[Found, np.ndarray, np.ndarray] | None = None,
    ) -> np.ndarray:
        """Of any pairs whose words belong here, given customers and tables of the context of each pair."""
        at, entry, seen = found or self.find(keys, before)
        passed = (STRENGTH + own * tables) / (customers + STRENGTH) * self.shard.probabilities(keys, totals, at)
        if not len(self.keys):
            return passed
        return passed + np.where(seen, (self.customers[entry] - own * self.tables[entry]) / (customers + STRENGTH), 0.0)


def _find(ordered: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted value, and whether it is there; place 0 where it is not."""
    if not len(ordered):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(ordered, wanted), len(ordered) - 1)
    there = ordered[place] == wanted
    return np.where(there, place, 0), there
