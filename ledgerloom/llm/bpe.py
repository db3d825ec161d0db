"""Byte-level BPE by tree concatenation, and back.

Texts are cut where the tokenizer splits them anyway, and every different chunk of a slice is encoded
once. Long runs that it does not split are encoded half by half: the halves on their own, and around
each join a window that grows until the tokens at both its edges are those of the halves again. Every
pair of neighbours is then one that the tokenizer would have left beside each other, which makes the
whole sequence the one it finds itself.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ledgerloom.llm.stored import stored
from ledgerloom.llm.textbytes import give_back, slices, span_hashes

DECODED_ROWS = 500
LEAF = 512  # bytes of an unsplit run that are encoded in one go
SPREAD_CHARS = 4_000_000  # texts beyond this are encoded by many tasks
PART_BYTES = 64 * 1024
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    letters = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}
    return [letters[b] for b in range(256)]


_LETTERS = _byte_letters()
_BYTES = {letter: byte for byte, letter in enumerate(_LETTERS)}
_AS_LETTERS = dict(enumerate(_LETTERS))


def join_encodings(
    left: list[int], right: list[int], encode: Callable[[bytes], list[int]], tokens: list[bytes]
) -> list[int]:
    """The encoding of two neighbouring runs from their own encodings."""
    size = 1
    while left and right:
        a, b = left[-size:], right[:size]
        window = encode(b"".join(tokens[i] for i in a + b))
        if (size >= len(left) or window[0] == a[0]) and (size >= len(right) or window[-1] == b[-1]):
            return left[:-size] + window + right[size:]
        size *= 2
    return left or right


def encode_tree(run: bytes, encode: Callable[[bytes], list[int]], tokens: list[bytes], leaf: int = LEAF) -> list[int]:
    """Halves, halves of halves, and so on up to `leaf` bytes; then joined upwards."""
    parts = [run]
    while len(parts[0]) > max(leaf, 1):
        parts = [half for p in parts for half in (p[: (len(p) + 1) // 2], p[(len(p) + 1) // 2 :])]
    encoded = [encode(p) if p else [] for p in parts]
    while len(encoded) > 1:
        encoded = [join_encodings(a, b, encode, tokens) for a, b in zip(encoded[::2], encoded[1::2])]
    return encoded[0]


class ByteBpe:
    """One tokenizer file, with what the fast ways need."""

    def __init__(self, path: str):
        # tasks share out the cores already, and each thread of the library keeps memory of its own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        # no cache: chunks are encoded once anyway
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.added = {t["id"]: t["content"] for t in said["added_tokens"]}
        vocabulary = {word: n for word, n in said["model"]["vocab"].items() if n not in self.added}
        self.tokens: list[bytes] = [b""] * (max([*vocabulary.values(), *self.added]) + 1)
        for word, n in vocabulary.items():
            self.tokens[n] = bytes(map(_BYTES.__getitem__, word))
        for n, content in self.added.items():
            self.tokens[n] = content.encode()
        self.sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        ranks = [vocabulary[a + b] for a, b in pairs]
        if said["pre_tokenizer"]["type"] != "ByteLevel" or said["normalizer"] or ranks != sorted(ranks):
            raise ValueError(f"{path} is no byte-level BPE with tokens in the order of merges")
        self.fast = tiktoken.Encoding(
            path,
            pat_str=_PATTERN,
            mergeable_ranks={self.tokens[n]: n for n in vocabulary.values()},
            special_tokens={},
        )

    def encode_run(self, run: bytes) -> list[int]:
        """Bytes that are not to be split any further."""
        return [t.id for t in self.library.model.tokenize(run.decode("latin-1").translate(_AS_LETTERS))]

    def encode_chunk(self, chunk: bytes, leaf: int) -> list[int]:
        """A long chunk without added tokens: its pieces, and trees for the long ones."""
        text, ids = chunk.decode(), []
        for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(text):
            ids += encode_tree(bytes(map(_BYTES.__getitem__, letters)), self.encode_run, self.tokens, leaf)
        return ids

    def encode_all(self, texts: list[bytes], leaf: int = LEAF) -> list[np.ndarray]:
        """Ids of every text, as the library gives them without adding special tokens."""
        added = [content.encode() for content in self.added.values()]
        whole = [any(content in t for content in added) for t in texts]
        ids, bounds = self._encode_plain([b"" if w else t for t, w in zip(texts, whole)], leaf)
        out = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for row in np.flatnonzero(whole):
            out[row] = np.array(self._encode_around(texts[row], leaf), np.uint32)
        return out

    def _encode_around(self, text: bytes, leaf: int) -> list[int]:
        """Text with added tokens in it: they are found first, from the left, the longest of equal starts."""
        contents = sorted(((c.encode(), n) for n, c in self.added.items()), key=lambda x: -len(x[0]))
        ids, start = [], 0
        while True:
            found = [(at, k) for k, (c, _) in enumerate(contents) if (at := text.find(c, start)) >= 0]
            at, k = min(found, default=(len(text), -1))
            plain, _ = self._encode_plain([text[start:at]], leaf)
            ids += plain.tolist()
            if k < 0:
                return ids
            ids.append(contents[k][1])
            start = at + len(contents[k][0])

    def _encode_plain(self, texts: list[bytes], leaf: int) -> tuple[np.ndarray, np.ndarray]:
        data, starts, ends, owner = cut_chunks(texts)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        keys = span_hashes(data, starts, ends)
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        highest = np.maximum.reduceat(data, starts)[first]
        highest[np.logical_or.reduceat(data == 0xC2, starts)[first]] = 0xFF
        ids, at, counts = self._encode_chunks(data, starts[first], ends[first], highest, leaf)
        taken = counts[which]
        upto = np.cumsum(taken)
        places = np.arange(upto[-1]) + np.repeat(at[which] - (upto - taken), taken)
        bounds = np.concatenate(([0], upto))[np.searchsorted(owner, np.arange(len(texts) + 1))]
        return ids[places], bounds

    def _encode_chunks(self, data, starts, ends, highest, leaf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different chunks, and where those of each chunk start and how many they are.

        `highest` is each chunk's highest byte, 0xFF where a byte is 0xC2.
        """
        # a space, then plain letters to the end: such chunks side by side are split as on their own
        plain = (data[starts] == 0x20) & (data[ends - 1] > 0x20) & (data[ends - 1] != 0x7F)
        plain &= (highest < 0xCE) & (ends - starts <= leaf)
        at, counts = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        rows, others = np.flatnonzero(plain), np.flatnonzero(~plain)
        raw = data.tobytes()
        joined = b"".join([raw[a:b] for a, b in zip(starts[rows].tolist(), ends[rows].tolist())])
        ids = [self.fast.encode_to_numpy(joined.decode(), disallowed_special=()).astype(np.uint32)]
        reached = np.concatenate(([0], np.cumsum(self.sizes[ids[0]])))
        edges = np.concatenate(([0], np.cumsum((ends - starts)[rows])))
        cuts = np.searchsorted(reached, edges)
        if not np.array_equal(reached[cuts], edges):
            raise AssertionError("a token crosses two chunks")
        at[rows], counts[rows] = cuts[:-1], np.diff(cuts)
        have = len(ids[0])
        short = [k for k in others if ends[k] - starts[k] <= leaf]
        encoded = self.library.encode_batch_fast(
            [raw[starts[k] : ends[k]].decode() for k in short], add_special_tokens=False
        )
        found = [(k, e.ids) for k, e in zip(short, encoded)]
        found += [(k, self.encode_chunk(raw[starts[k] : ends[k]], leaf)) for k in others if ends[k] - starts[k] > leaf]
        for k, some in found:
            at[k], counts[k] = have, len(some)
            ids.append(np.array(some, np.uint32))
            have += len(some)
        return np.concatenate(ids), at, counts

    def decode(self, ids: list[int]) -> str:
        """Bytes that are no UTF-8 become replacement characters; unknown ids are left out."""
        tokens = self.tokens
        try:
            joined = b"".join(map(tokens.__getitem__, ids))
        except IndexError:
            joined = b"".join(tokens[i] for i in ids if 0 <= i < len(tokens))
        return joined.decode("utf-8", "replace")


# Lead bytes of letters beyond ASCII that may be white space.
_MAYBE_SPACE = (0xC2, 0xE1, 0xE2, 0xE3)


def cut_chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, starts and ends of chunks, and the text of each.

    Cuts lie before a space that a letter or sign follows, and after a single line end between two.
    The tokenizer always splits there, and in the same way whether it sees one side or both.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    graphic = (data > 0x20) & (data < 0x7F)
    solid = (graphic | (data >= 0x80)) & ~np.isin(data, _MAYBE_SPACE)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[:-2] = (data[:-1] == 0x20) & solid[1:]
    if len(data) > 2:
        cut[2:-1] |= (data[1:-1] == 0x0A) & graphic[:-2] & solid[2:]
    cut[bounds] = True  # the rules look across two texts at most here, where a cut is right anyway
    last = bounds[1:-1]
    near = np.concatenate((last + 1, last - 1))
    near = near[(near > 0) & (near < len(data))]
    # decide again beside the bounds, without the neighbouring text
    for place in near.tolist():
        text = np.searchsorted(bounds, place, side="right") - 1
        lo, hi = bounds[text], bounds[text + 1]
        spaced = data[place] == 0x20 and place + 1 < hi and solid[place + 1]
        ended = place - 2 >= lo and data[place - 1] == 0x0A and graphic[place - 2] and solid[place]
        cut[place] = place in (lo, hi) or spaced or ended
    starts = np.flatnonzero(cut[:-1])
    ends = np.concatenate((starts[1:], [len(data)])).astype(np.int64) if len(starts) else starts
    owner = np.searchsorted(bounds, starts, side="right") - 1
    return data, starts, ends, owner


@lru_cache(maxsize=2)
def bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def _id_lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate([*rows, np.zeros(0, np.uint32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def _encode_narrow(texts: DataFrame, key: str, text: str, path: str, leaf: int) -> DataFrame:
    """Each task encodes its rows; nothing is shuffled.

    The tokenizer does not outlive its task: workers take on other work next, beside those that encode.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for batch in batches:
            for rows, some in slices(batch, text):
                model = model or ByteBpe(path)
                ids = _id_lists(model.encode_all(some, leaf))
                yield pa.RecordBatch.from_arrays([rows.column(0), ids], names=[key, "ids"])
                del some, ids
                give_back()
        del model
        give_back()

    schema = T.StructType([texts.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return texts.select(key, text).mapInArrow(run, schema)


def _encode_spread(texts: DataFrame, key: str, text: str, path: str, leaf: int, part: int) -> DataFrame:
    """Very long texts: parts of about `part` bytes go to tasks of their own, then joins level by level.

    A part is a stretch between two cuts, or a node of the tree over one unsplit run: (row, stretch, node).
    """
    numbered = stored(texts.select(key, text, F.monotonically_increasing_id().alias("_row")))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, some in slices(batch, text):
                for row, whole in zip(rows.column(2).to_pylist(), some):
                    laid = list(_stretches(bpe(path), whole, part))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row] * len(laid), pa.int64()),
                            *(pa.array([x[k] for x in laid], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.bool_(), pa.binary()))),
                        ],
                        names=["_row", "stretch", "node", "run", "bytes"],
                    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                encode_tree(b, bpe(path).encode_run, bpe(path).tokens, leaf) if run else bpe(path).encode_all([b], leaf)[0]
                for run, b in zip(batch.column("run").to_pylist(), batch.column("bytes").to_pylist())
            ]
            ids = _id_lists([np.array(x, np.uint32) for x in found])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], ids], names=["_row", "stretch", "node", "ids"])

    def join(pair: pd.DataFrame) -> pd.DataFrame:
        pair = pair.sort_values("node")
        ids = [list(map(int, x)) for x in pair["ids"]]
        both = join_encodings(*ids, bpe(path).encode_run, bpe(path).tokens) if len(ids) == 2 else ids[0]
        first = pair.iloc[0]
        return pd.DataFrame({"_row": [first["_row"]], "stretch": [first["stretch"]], "node": [first["node"] // 2], "ids": [both]})

    nodes = "_row long, stretch long, node long, ids array<int>"
    laid = numbered.mapInArrow(lay, "_row long, stretch long, node long, run boolean, bytes binary")
    done = stored(laid.repartition(F.col("_row"), F.col("stretch"), F.col("node")).mapInArrow(encode, nodes))
    # all nodes of a run are on one level, so a run whose only node is 0 is done
    trees = done.where("node > 0").select("_row", "stretch").distinct()
    done, open_ = done.join(trees, ["_row", "stretch"], "left_anti"), done.join(trees, ["_row", "stretch"], "left_semi")
    while (open_.select(F.max("node")).first()[0] or 0) > 0:
        open_ = stored(open_.groupBy("_row", "stretch", F.floor(F.col("node") / 2)).applyInPandas(join, nodes))
    joined = done.unionByName(open_).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("stretch", "ids"))).alias("parts"))
    whole = numbered.select(key, "_row").join(joined, "_row", "left")
    return whole.select(key, F.coalesce(F.flatten("parts.ids"), F.array().cast("array<int>")).alias("ids"))


def _stretches(model: ByteBpe, text: bytes, part: int) -> Iterator[tuple[int, int, bool, bytes]]:
    """(number, node, unsplit run?, bytes): chunks up to `part` bytes together, longer runs in halves."""
    number, have = 0, b""
    added = [c.encode() for c in model.added.values()]
    if any(c in text for c in added):  # found before anything is split, so such a text stays whole
        yield 0, 0, False, text
        return
    data, starts, ends, _ = cut_chunks([text])
    for a, b in zip(starts.tolist(), ends.tolist()):
        chunk = text[a:b]
        if have and len(have) + len(chunk) > part:
            yield number, 0, False, have
            number, have = number + 1, b""
        if len(chunk) <= part:
            have += chunk
            continue
        for letters, _ in model.library.pre_tokenizer.pre_tokenize_str(chunk.decode()):
            halves = [bytes(map(_BYTES.__getitem__, letters))]
            while len(halves[0]) > part:
                halves = [h for p in halves for h in (p[: (len(p) + 1) // 2], p[(len(p) + 1) // 2 :])]
            yield from ((number, node, True, h) for node, h in enumerate(halves))
            number += 1
    if have:
        yield number, 0, False, have


def encode_texts(
    texts: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    leaf: int = LEAF,
    spread_chars: int = SPREAD_CHARS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """`key` and ids (array<int>) of every row, as the tokenizer file at `path` encodes its whole text.

    Added special tokens are recognised in texts, none is put around them. Texts of more than
    `spread_chars` characters are shared out among tasks, about `part_bytes` each; both ways give the same
    ids. `leaf` is the number of bytes of an unsplit run that is encoded at once.

    A null text counts as empty and has no ids. Repeated rows and null keys are kept as they are, an
    empty table gives an empty result, and other columns are neither read nor returned.
    """
    texts = texts.select(key, text)
    long = F.coalesce(F.length(text) > spread_chars, F.lit(False))
    near = _encode_narrow(texts.where(~long), key, text, path, leaf)
    lengths = texts.select(F.max(F.octet_length(text))).first()[0] or 0
    if lengths <= spread_chars:  # characters are bytes at least
        return near
    far = _encode_spread(texts.where(long), key, text, path, leaf, part_bytes)
    return near.unionByName(far)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The table with the text of each row's ids in column `decoded`, special tokens included.

    No ids or null give an empty text, ids outside the vocabulary nothing, and bytes that are no UTF-8
    replacement characters. A column that is already called `decoded` is replaced.
    """

    kept = [name for name in encoded.columns if name != decoded]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, DECODED_ROWS):
                rows = batch.slice(start, DECODED_ROWS)
                column = rows.column(rows.schema.get_field_index(ids))
                texts = [bpe(path).decode([] if not x.is_valid else x.values.to_pylist()) for x in column]
                columns = [rows.column(rows.schema.get_field_index(name)) for name in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*kept, decoded])

    schema = T.StructType([*(encoded.schema[name] for name in kept), T.StructField(decoded, T.StringType())])
    return encoded.mapInArrow(run, schema)
