"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The corpus' most frequent pieces (a word with the space before it) are counted over
all documents and compiled into a minimal acyclic automaton: words share prefixes and
suffixes, and the number of words passed on the way gives each word its place in a
table of id sequences. The automaton is five flat arrays in one file, delivered with
the job and memory-mapped by every worker. A batch looks up all its distinct pieces
at once, one byte of each per step. Pieces that are not in the lexicon are split by the
tokenizer's own rule and merged exactly, all of them side by side, lowest rank first
and leftmost first among equals; so the lexicon only saves work.

Decoding looks up each id's bytes and lays them end to end.

Defined results. Null or empty text: no ids, and the empty text back. A special
token's string in a text becomes its id, as the library does. Repeated rows are
encoded each; rows and other columns pass through in any number. No rows: no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pullgrid.folders import shared_dir
from pullgrid.llm.common import table, written
from pullgrid.llm.pieces import PieceEncoder
from pullgrid.llm.ragged import gather, offsets
from pullgrid.llm.slices import text_slices
from pullgrid.shipping import ship_package

LEXICON_WORDS = 50_000
LEXICON_WORD_BYTES = 40

# fixed by the tokenizer: how a text is split before merging
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LAST_COMMON = "ɏ"  # up to here all versions of the character tables agree


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Merger:
    """Exact merging of many words side by side."""

    SLOTS = 1 << 19
    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, model: dict):
        letters = byte_letters()
        vocab = model["model"]["vocab"]
        spelled = {bytes(letters[c] for c in token): i for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        strings = [b""] * size
        for token, i in spelled.items():
            strings[i] = token
        for token, i in self.special.items():
            strings[i] = token.encode()
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = offsets(self.lengths)[:-1]
        self.of_byte = np.array([spelled[bytes([b])] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.size = size
        self.none = len(pairs)  # the rank of a pair that does not merge
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        born = {int(i): rank for rank, i in reversed(list(enumerate(self.merged)))}
        for rank, (a, b) in enumerate(pairs):
            if max(born.get(vocab[a], -1), born.get(vocab[b], -1)) >= rank:
                raise ValueError("a merge comes before one that it needs")
        self.keys = np.full(self.SLOTS, -1, np.int64)
        self.ranks = np.full(self.SLOTS, self.none, np.int32)
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist(), strict=True)):
            while self.keys[slot] >= 0:
                slot = (slot + 1) % self.SLOTS
            self.keys[slot], self.ranks[slot] = key, rank
        self.split = regex.compile(SPLIT)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.MIX) >> np.uint64(64 - 19)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.size + right
        slots = self._slot(keys)
        out = np.full(len(keys), self.none, np.int32)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
            slots[open_] = (slots[open_] + 1) % self.SLOTS
        return out

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number of ids of each word)."""
        lengths = np.array([len(w) for w in words], np.int64)
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_word, done_symbols, done_at = [], [], []
        at = np.arange(len(symbols))
        last = np.append(word[1:] != word[:-1], True) if len(word) else np.zeros(0, bool)
        rank = np.full(len(symbols), self.none, np.int32)
        inner = np.flatnonzero(~last)
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        while len(symbols):
            firsts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(firsts, len(word)))
            best = np.minimum.reduceat(rank, firsts)
            if (best == self.none).any():
                over = np.repeat(best == self.none, sizes)
                done_word.append(word[over])
                done_symbols.append(symbols[over])
                done_at.append(at[over])
                word, symbols, at, rank = word[~over], symbols[~over], at[~over], rank[~over]
                if not len(word):
                    break
                keep = best != self.none
                best, sizes = best[keep], sizes[keep]
            here = rank == np.repeat(best, sizes)
            # of pairs that overlap (one letter three times or more) every other one merges
            picked = np.flatnonzero(here)
            run = np.append(True, picked[1:] != picked[:-1] + 1)
            place = np.arange(len(picked))
            place -= np.maximum.accumulate(np.where(run, place, 0))
            picked = picked[place % 2 == 0]
            symbols[picked] = self.merged[rank[picked]]
            stay = np.ones(len(word), bool)
            stay[picked + 1] = False
            moved = np.cumsum(stay) - 1
            word, symbols, at, rank = word[stay], symbols[stay], at[stay], rank[stay]
            now = moved[picked]
            touched = np.unique(np.concatenate([now, now[now > 0] - 1]))
            inner = touched < len(word) - 1
            inner[inner] = word[touched[inner]] == word[touched[inner] + 1]
            rank[touched] = self.none
            pairs = touched[inner]
            rank[pairs] = self.rank(symbols[pairs], symbols[pairs + 1])
        if not done_word:
            return np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        order = np.argsort(np.concatenate(done_at), kind="stable")
        counts = np.bincount(np.concatenate(done_word), minlength=len(words))
        return np.concatenate(done_symbols)[order].astype(np.uint32), counts.astype(np.int64)

    def split_text(self, text: str) -> list[str]:
        if max(text, default=" ") <= LAST_COMMON:
            return self.split.findall(text)
        return _library_split(text)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that the split rule keeps apart, each split and merged."""
        parts: list[bytes] = []
        counts = np.empty(len(pieces), np.int64)
        for k, piece in enumerate(pieces):
            split = self.split_text(piece)
            counts[k] = len(split)
            parts += [p.encode() for p in split]
        ids, sizes = self.merge(parts)
        ends, bounds = offsets(sizes), offsets(counts)
        return ids, ends[bounds[1:]] - ends[bounds[:-1]]

    def encode_whole(self, text: str) -> np.ndarray:
        """Ids of a text in which special tokens may stand."""
        if not any(s in text for s in self.special):
            return self.encode_pieces([text])[0]
        pattern = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        out = []
        for part in regex.split(f"({pattern})", text):
            if part in self.special:
                out.append(np.array([self.special[part]], np.uint32))
            elif part:
                out.append(self.encode_pieces([part])[0])
        return np.concatenate(out)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.bytes, self.starts[ids], self.lengths[ids])


def _library_split(text: str) -> list[str]:
    """The library's own split, for letters on which character tables may differ."""
    from tokenizers.pre_tokenizers import ByteLevel

    splitter = ByteLevel(add_prefix_space=False, trim_offsets=False, use_regex=True)
    return [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)]


class Lexicon:
    """A minimal acyclic transducer from words to id sequences, as flat arrays."""

    FIELDS = ("edge_key", "edge_to", "edge_skip", "final", "id_start", "ids")

    @classmethod
    def compile(cls, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> dict:
        """Arrays of the automaton of sorted distinct words; built by adding one word after another."""
        register: dict[tuple, int] = {}
        nodes: list[tuple[bool, tuple]] = []
        path: list[list] = [[False, {}]]  # unfinished nodes along the last word

        def frozen(node: list) -> int:
            key = (node[0], tuple(node[1].items()))
            if key not in register:
                register[key] = len(nodes)
                nodes.append(key)
            return register[key]

        before = b""
        for word in words:
            shared = len(os.path.commonprefix([before, word]))
            for k in range(len(before), shared, -1):
                child = path.pop()
                path[-1][1][before[k - 1]] = frozen(child)
            for letter in word[shared:]:
                path[-1][1][letter] = -1
                path.append([False, {}])
            path[-1][0] = True
            before = word
        for k in range(len(before), 0, -1):
            child = path.pop()
            path[-1][1][before[k - 1]] = frozen(child)
        root = frozen(path[0])
        # words below each node; children are always frozen before their parents
        below = np.zeros(len(nodes), np.int64)
        edges = []
        for n, (final, children) in enumerate(nodes):
            passed = int(final)
            for letter, child in sorted(children):
                edges.append((n << 8 | letter, child, passed))
                passed += int(below[child])
            below[n] = passed
        edges.sort()
        keys, to, skip = (np.array(x, np.int64) for x in zip(*edges, strict=True)) if edges else (
            np.zeros(0, np.int64),
        ) * 3
        return {
            "edge_key": keys,
            "edge_to": to,
            "edge_skip": skip,
            "final": np.array([f for f, _ in nodes] + [root], np.int64),
            "id_start": offsets(lengths),
            "ids": ids.astype(np.int64),
        }

    @classmethod
    def save(cls, arrays: dict) -> bytes:
        sizes = np.array([len(arrays[f]) for f in cls.FIELDS], np.int64)
        return b"".join([sizes.tobytes(), *(arrays[f].astype(np.int64).tobytes() for f in cls.FIELDS)])

    def __init__(self, flat: np.ndarray):
        ends = offsets(flat[: len(self.FIELDS)]) + len(self.FIELDS)
        for k, field in enumerate(self.FIELDS):
            setattr(self, field, flat[ends[k] : ends[k + 1]])
        self.root = int(self.final[-1])

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, np.int64, "r"))

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the lexicon, or -1; all words advance one byte a step."""
        lengths = np.array([len(w) for w in words], np.int64)
        letters, starts = np.frombuffer(b"".join(words), np.uint8), offsets(lengths)[:-1]
        place = np.full(len(words), -1, np.int64)
        if not len(self.edge_key):
            return np.where(lengths == 0, self.final[self.root] - 1, -1)
        active = np.arange(len(words))
        state, skipped = np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(active):
            ended = lengths[active] == step
            over = active[ended]
            place[over] = np.where(self.final[state[over]] == 1, skipped[over], -1)
            active = active[~ended]
            keys = state[active] << 8 | letters[starts[active] + step]
            at = np.minimum(np.searchsorted(self.edge_key, keys), len(self.edge_key) - 1)
            hit = self.edge_key[at] == keys
            active, at = active[hit], at[hit]
            state[active] = self.edge_to[at]
            skipped[active] += self.edge_skip[at]
            step += 1
        return place

    def outputs(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.id_start[place]
        lengths = self.id_start[place + 1] - starts
        return gather(self.ids, starts, lengths).astype(np.uint32), lengths


@lru_cache(maxsize=2)
def merger(tokenizer: str) -> Merger:
    with open(tokenizer, encoding="utf-8") as file:
        return Merger(json.load(file))


@lru_cache(maxsize=2)
def encoder(tokenizer: str, lexicon: str) -> PieceEncoder:
    """The worker's encoder: its merge table, and the lexicon's file mapped into memory."""
    merging, words = merger(tokenizer), Lexicon.mapped(SparkFiles.get(lexicon))

    def encode_many(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        spelled = [p.encode() for p in pieces]
        place = words.find(spelled)
        known, unseen = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
        known_ids, known_lengths = words.outputs(place[known])
        other_ids, other_lengths = merging.encode_pieces([pieces[i] for i in unseen])
        lengths = np.zeros(len(pieces), np.int64)
        lengths[known], lengths[unseen] = known_lengths, other_lengths
        starts = np.zeros(len(pieces), np.int64)
        starts[known] = offsets(known_lengths)[:-1]
        starts[unseen] = offsets(other_lengths)[:-1] + len(known_ids)
        return gather(np.concatenate([known_ids, other_ids]), starts, lengths), lengths

    return PieceEncoder(encode_many, merging.encode_whole, tuple(merging.special))


def frequent_pieces(docs: DataFrame, n_words: int) -> DataFrame:
    """(piece, n): ``n_words`` pieces at most, those that all documents together hold most often."""
    pieces = docs.select(F.explode(F.split("text", " ", -1)).alias("piece"))
    plain = pieces.where(
        (F.octet_length("piece") < LEXICON_WORD_BYTES)
        & (F.col("piece") != "")
        & ~F.col("piece").rlike(r"(?U)^\s|\s$")
    )
    counted = written(plain.groupBy("piece").agg(F.count("*").alias("n")).where("n > 1"), "pieces")
    # the least count that at most n_words pieces reach, from a few hundred count classes
    level = F.floor(F.log2("n") * 16).cast("int")
    sizes = counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, cut = 0, None
    for row in sizes:
        total += row["count"]
        if total > n_words:
            break
        cut = row["level"]
    return counted.where(F.lit(False) if cut is None else level >= cut)


def deliver_lexicon(spark: SparkSession, docs: DataFrame, tokenizer: str, n_words: int) -> str:
    """Count, compile and deliver the lexicon; its file name on the workers."""
    rows = frequent_pieces(docs, n_words).select("piece").toArrow()  # n_words rows at most
    spelled = sorted(f" {p}" for p in rows.column("piece").to_pylist())
    spelled.sort(key=str.encode)
    ids, lengths = merger(tokenizer).encode_pieces(spelled)
    content = Lexicon.save(Lexicon.compile([s.encode() for s in spelled], ids, lengths))
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = f"{shared_dir(spark)}/{name}"
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(content)
    out.close()
    spark.sparkContext.addFile(path)
    return name


def encode(
    docs: DataFrame,
    tokenizer: str,
    carried: list[str],
    n_words: int = LEXICON_WORDS,
    output: str = "digest",
) -> DataFrame:
    """Carried columns with the ids of each text.

    ``digest`` adds n_tokens, ids_sha256 and decoded_sha256 of the ids decoded again;
    ``ids`` adds ids (array<int>) and decoded (string).
    """
    spark = docs.sparkSession
    ship_package(spark)
    lexicon = deliver_lexicon(spark, docs, tokenizer, n_words)
    added = (
        "n_tokens long, ids_sha256 string, decoded_sha256 string"
        if output == "digest"
        else "ids array<int>, decoded string"
    )
    packed = docs.select(F.struct(*carried).alias("row"), "text")
    row_type = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merging, encoding = merger(tokenizer), encoder(tokenizer, lexicon)
        for batch in text_slices(batches):
            ids, counts = encoding(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *_outputs(merging, ids, counts, output)],
                ["row", *[a.split(" ")[0] for a in added.split(", ")]],
            )

    return packed.mapInArrow(run, f"row {row_type}, {added}")


def _outputs(merging: Merger, ids: np.ndarray, counts: np.ndarray, output: str) -> list[pa.Array]:
    ends = offsets(counts)
    raw = merging.decode(ids)
    raw_ends = offsets(merging.lengths[ids])[ends]
    if output == "digest":
        ids_hash, text_hash = [], []
        for k in range(len(counts)):
            ids_hash.append(hashlib.sha256(ids[ends[k] : ends[k + 1]].astype("<u4")).hexdigest())
            text_hash.append(_text_hash(raw[raw_ends[k] : raw_ends[k + 1]]))
        return [pa.array(counts), pa.array(ids_hash), pa.array(text_hash)]
    lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
    texts = [
        raw[raw_ends[k] : raw_ends[k + 1]].tobytes().decode("utf-8", "replace")
        for k in range(len(counts))
    ]
    return [lists, pa.array(texts, pa.string())]


def _text_hash(raw: np.ndarray) -> str:
    content = raw.tobytes()
    return hashlib.sha256(content.decode("utf-8", "replace").encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])
    return encoded.select(
        F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256"
    )
