"""Two tokenizers' tokens of the same texts, cut into groups at common ends, with linked ids counted over all texts.

Coarse cuts come from the libraries: ``tokenizers`` gives the character offsets of its tokens, and the proto
of ``sentencepiece`` the span of each piece. Offsets are turned into bytes of the text. A token that ends inside a
character, or is a byte of one, has no cut of its own there; its end is the end before plus its
decoded bytes. Whatever the spans say, the decoded bytes must make up the text, else the text has no tokens.

Both tokenizers end a token before a blank that follows a visible character, so texts are cut there, and each
different stretch is encoded and aligned once and kept (``KEPT`` at most at a time, ``KEPT_LENGTH`` characters each). If the
second vocabulary has a piece that holds a blank behind another character, texts are taken whole.

Counts of id pairs are summed per chunk of documents (``CHUNK`` bytes of text, or one long text), then
over chunks. Each chunk gets back the counts of its own pairs by a join, and sums them up for its documents; nothing is
broadcast but the highest count of each id of the second vocabulary, which is as long as that vocabulary at the most.

Defined results of ``align_documents``: texts null, empty, or not made up by their tokens have zeros and '' as digest; rows
without a doc_id count like others; repeated rows count again; an empty table gives no rows; other columns are ignored.
Bytes that are not UTF-8 are read as U+FFFD. A text is aligned whole, whatever its length.
"""

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallybrook.llm.common import id_and_bytes, portions, ship, stored

CHUNK = 4 << 20
KEPT = 450_000
KEPT_LENGTH = 64
ROW = 256
SLAB = 40
MARK = "▁"
_VISIBLE = (
    r"!-~\u00a1-\u167f\u1681-\u180d\u180f-\u1fff\u2010-\u2027\u2030-\u205e\u2070-\u2580\u2582-\u2fff\u3001-\ud7ff"
    r"\uf900-\ufefe\uff00-\U0010ffff"
)
_STRETCHES = re.compile(rf"(?<=[{_VISIBLE}])(?=\x20\s*[{_VISIBLE}])")
_ENDS = re.compile(f"[{_VISIBLE}]")
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
CHUNKED = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "body binary, codes array<long>, counts array<long>"
)


def byte_ends(first: np.ndarray, cuts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Where tokens end in the joined bytes of all texts: at the cut where there is one (not -1), else behind their decoded bytes.

    ``first`` marks the first token of a text; cuts count from the first byte of all.
    """
    behind = np.cumsum(sizes)
    known = np.flatnonzero(cuts >= 0)
    # The last token with a cut, itself included, and by how much decoded bytes miss the cut there.
    last = np.searchsorted(known, np.arange(len(cuts)), side="right") - 1
    began = np.maximum.accumulate(np.where(first, np.arange(len(cuts)), 0))
    at = known[np.maximum(last, 0)] if len(known) else np.zeros(len(cuts), dtype=np.int64)
    usable = (last >= 0) & (at >= began)
    return behind + np.where(usable, cuts[at] - behind[at], 0) if len(known) else behind


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens that overlap. Two tokens share one run of bytes, which no end of either side divides."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class Aligner:
    """Stretches by number: their figures, groups and codes (id of A times 65,536 plus id of B)."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        # The byte-level alphabet: visible bytes stand for themselves, the others follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in shown]
        byte = {chr(x): x for x in shown} | {chr(256 + n): x for n, x in enumerate(hidden)}
        self.bytes_a = {i: bytes(byte.get(c, 0) for c in token) for token, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.single = [self.b.is_byte(i) for i in range(len(pieces))]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if single else p.replace(MARK, " ").encode("utf-8")
            for p, single in zip(pieces, self.single, strict=True)
        ]
        self.separable = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.sizes_a = np.zeros(max(self.bytes_a, default=-1) + 1, dtype=np.int64)
        for i, token in self.bytes_a.items():
            self.sizes_a[i] = len(token)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        numbers = range(max(len(self.sizes_a), len(pieces)))
        self.said = {sign: np.array([f"{i}{sign}" for i in numbers], dtype=object) for sign in ",|;\n"}
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.figures = np.empty((0, 4), dtype=np.int32)
        self.groups: list[str | None] = []
        self.codes = np.empty(0, dtype=np.uint32)
        self.starts = np.empty(0, dtype=np.int64)

    def stretches(self, text: str) -> list[str]:
        return _STRETCHES.split(f" {text}") if self.separable else [f" {text}"]

    @staticmethod
    def cuts_a(text: str, found) -> list[int]:
        offsets = found.offsets
        to_byte = range(len(text) + 1) if text.isascii() else [0, *accumulate(len(c.encode("utf-8")) for c in text)]
        # A token that shares its last character with the next one ends inside it.
        return [to_byte[end] if after[0] >= end else -1 for (_, end), after in zip(offsets, [*offsets[1:], (len(text), 0)])]

    def cuts_b(self, text: str, pieces) -> list[int]:
        """Spans don't count the blank that the library puts before a text. Bytes of a character share a span, which the last one has."""
        if not text.isascii():
            # Releases of the library differ in whether spans count characters or bytes.
            return [-1] * len(pieces)
        return [-1 if self.single[x.id] or x.begin == x.end else x.end + 1 for x in pieces]

    def learn(self, texts: list[str]) -> None:
        """Align ``texts``, each beginning with the blank that the second library puts before what it is given.

        Those that end with a visible character are encoded in rows of ``ROW``, which changes nothing for tokens end between them.
        """
        whole = [x for x in texts if self.separable and _ENDS.match(x[-1])]
        units = [whole[i : i + ROW] for i in range(0, len(whole), ROW)]
        for number, text in enumerate(texts, len(self.groups)):
            self.numbers[text] = number
        self.groups += [None] * len(texts)
        self.figures = np.concatenate([self.figures, np.zeros((len(texts), 4), dtype=np.int32)])
        self.starts = np.concatenate([self.starts, np.zeros(len(texts), dtype=np.int64)])
        joined = set(whole)
        # A row with a text that its tokens don't make up is taken text by text.
        failed = [x for unit in self._learn_slabs(units) for x in unit]
        self._learn_slabs([[x] for x in [*failed, *(x for x in texts if x not in joined)]])

    def _learn_slabs(self, units: list[list[str]]) -> list[list[str]]:
        """A few units at a time: what the libraries return for a text takes many times its memory."""
        out, codes = [], [self.codes]
        at = len(self.codes)
        for i in range(0, len(units), SLAB):
            failed, more = self._learn(units[i : i + SLAB], at)
            out += failed
            codes.append(more)
            at += len(more)
        self.codes = np.concatenate(codes)
        return out

    def _learn(self, units: list[list[str]], begins: int) -> tuple[list[list[str]], np.ndarray]:
        """Align each unit's texts joined; the units that their tokens don't make up, and the codes of the others."""
        texts = ["".join(unit) for unit in units]
        found = self.a.encode_batch(texts, add_special_tokens=False)
        kept, failed, ids, cuts = [], [], ([], []), ([], [])
        for unit, text, a in zip(units, texts, found):
            b = self.b.encode(text[1:], return_type="proto").pieces
            ids_a, ids_b, body = a.ids, [x.id for x in b], text.encode("utf-8")
            if b"".join(map(self.bytes_a.__getitem__, ids_a)) != body or b"".join(map(self.bytes_b.__getitem__, ids_b)) != body:
                failed.append(unit)
                continue
            kept.append(unit)
            for side, these, at in zip((0, 1), (ids_a, ids_b), (self.cuts_a(text, a), self.cuts_b(text, b))):
                ids[side].append(these)
                cuts[side].append(at)
        codes = np.empty(0, dtype=np.uint32)
        if kept:
            flat = [x for unit in kept for x in unit]
            lengths = [np.array([len(x.encode("utf-8")) for x in unit]) for unit in kept]
            figures, codes, groups = self._aligned(ids, cuts, np.array([x.sum() for x in lengths]), np.concatenate(lengths))
            at = np.fromiter(map(self.numbers.__getitem__, flat), dtype=np.int64, count=len(flat))
            self.figures[at] = figures
            self.starts[at] = begins + np.cumsum(figures[:, 3]) - figures[:, 3]
            for i, group in zip(at.tolist(), groups, strict=True):
                self.groups[i] = group
        return failed, codes.astype(np.uint32)

    def _aligned(self, ids, cuts, units: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Figures and groups of each text (``lengths`` in bytes) of each unit, and the codes of all their links."""
        stop, began = np.cumsum(lengths), np.cumsum(units) - units
        flat, ends = [], []
        for sizes, of, at in zip((self.sizes_a, self.sizes_b), ids, cuts):
            n = np.array([len(x) for x in of])
            tokens = np.fromiter(chain.from_iterable(of), dtype=np.int64, count=int(n.sum()))
            coarse = np.fromiter(chain.from_iterable(at), dtype=np.int64, count=len(tokens))
            first = np.zeros(len(tokens), dtype=bool)
            first[np.cumsum(n) - n] = True
            coarse = np.where(coarse >= 0, coarse + np.repeat(began, n), -1)
            flat.append(tokens)
            ends.append(byte_ends(first, coarse, sizes[tokens]))
        i, j = links(*ends)
        codes = flat[0][i] << 16 | flat[1][j]
        common = np.intersect1d(*ends, assume_unique=True)

        def in_each(of_ends: np.ndarray) -> np.ndarray:
            return np.bincount(np.searchsorted(stop, of_ends), minlength=len(stop))

        # Tokens in the order of groups, the first side's before the second's, each with the sign behind it.
        group = [np.searchsorted(common, e) for e in ends]
        closes = [np.isin(e, common, assume_unique=True) for e in ends]
        said = [self.said[","][x] for x in flat]
        said[0][closes[0]] = self.said["|"][flat[0][closes[0]]]
        said[1][closes[1]] = self.said[";"][flat[1][closes[1]]]
        done = np.isin(ends[1], stop, assume_unique=True)
        said[1][done] = self.said["\n"][flat[1][done]]
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        groups = "".join(np.concatenate(said)[order].tolist()).split("\n")[:-1]
        figures = np.stack([in_each(x) for x in (*ends, common, np.union1d(*ends))], axis=1)
        return figures, codes, groups

    def chunk(self, texts: list[str]) -> tuple[list, bytes, np.ndarray, np.ndarray]:
        """For each text its figures, digest and packed stretches; the chunk's stretches; its pairs and their counts."""
        if len(self.groups) > KEPT:
            self.clear()
        cut = [self.stretches(text) if text else [] for text in texts]
        known = self.numbers
        new = list(dict.fromkeys(s for parts in cut for s in parts if s not in known))
        self.learn(new)
        rows, used = [], []
        for parts in cut:
            at = np.fromiter(map(known.__getitem__, parts), dtype=np.int64, count=len(parts))
            groups = [self.groups[i] for i in at.tolist()]
            if not parts or None in groups:
                rows.append((0, 0, 0, 0, "", None))
            else:
                rows.append((*self.figures[at].sum(axis=0, dtype=np.int64).tolist(), hashlib.sha256(";".join(groups).encode()).hexdigest(), at))
                used.append(at)
        of_all = np.concatenate(used) if used else np.empty(0, dtype=np.int64)
        kinds, times = np.unique(of_all, return_counts=True)
        sizes = self.figures[kinds, 3].astype(np.int64)
        starts = self.starts[kinds]
        codes = self.codes[np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]
        pairs, place = np.unique(codes, return_inverse=True)
        counts = np.bincount(place, weights=np.repeat(times, sizes), minlength=len(pairs)).astype(np.int64)
        body = _packed(sizes) + _packed(place)
        out = [(*row[:5], None if row[5] is None else _packed(np.searchsorted(kinds, row[5]))) for row in rows]
        for s in new:  # long ones are kept for this chunk alone
            if len(s) > KEPT_LENGTH:
                del known[s]
        return out, body, pairs.astype(np.int64), counts


def _packed(numbers: np.ndarray) -> bytes:
    data = zlib.compress(np.asarray(numbers, dtype="<u4").tobytes(), 1)
    return len(data).to_bytes(8, "little") + data


def _unpacked(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    end = at + 8 + int.from_bytes(data[at : at + 8], "little")
    return np.frombuffer(zlib.decompress(data[at + 8 : end]), dtype="<u4").astype(np.int64), end


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker and pair of vocabularies."""
    return Aligner(path_a, path_b)


def chunks(docs: DataFrame, path_a: str, path_b: str, size: int = CHUNK) -> DataFrame:
    """Documents with what is known of them alone, and for each chunk one row (``codes`` not null) with its pairs."""
    fields = [
        ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("body", pa.binary()),
        ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chunk = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for batch in batches:
            bodies = [x.as_py() for x in batch.column(1)]
            for began, ended in portions(bodies, size):
                docs_of = batch.column(0).slice(began, ended - began).to_pylist()
                texts = [x.decode("utf-8", "replace") for x in bodies[began:ended]]
                rows, body, codes, counts = own.chunk(texts)
                table = [(chunk, doc, *row, None, None) for doc, row in zip(docs_of, rows, strict=True)]
                table.append((chunk, None, 0, 0, 0, 0, None, body, codes, counts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), type=k) for c, (_, k) in zip(zip(*table, strict=True), fields, strict=True)],
                    names=[n for n, _ in fields])
                chunk += 1

    ship(docs.sparkSession)
    return id_and_bytes(docs).mapInArrow(cut, CHUNKED)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pairs`` (code, n) to code, count, best: whether no other pair of its second id has a higher count."""
    counts = stored(pairs.groupBy("code").agg(F.sum("n").alias("count")), "pair-counts")
    second = F.col("code").bitwiseAND(0xFFFF)
    # One row for each id of the second vocabulary at most.
    highest = F.broadcast(counts.groupBy(second.alias("b")).agg(F.max("count").alias("highest")))
    return counts.join(highest, second == F.col("b")).select("code", "count", (F.col("count") == F.col("highest")).alias("best"))


def _sum_up(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one chunk, with the counts of its pairs summed over their links."""
    is_doc = np.array(rows.column("of_pairs").is_null())
    body = rows.filter(pa.array(~is_doc)).column("body")[0].as_py()
    docs = rows.filter(pa.array(is_doc))
    sizes, at = _unpacked(body)
    place, _ = _unpacked(body, at)
    order = np.argsort(pairs.column("code").to_numpy(), kind="stable")
    of_stretch = np.repeat(np.arange(len(sizes)), sizes)
    sums = []
    for name in ("best", "count"):
        each = pairs.column(name).to_numpy(zero_copy_only=False).astype(np.int64)[order]
        # Whole numbers, so that sums are exact.
        total = np.zeros(len(sizes), dtype=np.int64)
        np.add.at(total, of_stretch, each[place])
        sums.append(total)
    n_best, count_sum = [], []
    for x in docs.column("body").to_pylist():
        used = _unpacked(x)[0] if x is not None else np.empty(0, dtype=np.int64)
        n_best.append(int(sums[0][used].sum()))
        count_sum.append(int(sums[1][used].sum()))
    out = {n: docs.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    out |= {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    return pa.table(out | {"groups_sha256": docs.column("groups_sha256")})


def align_documents(docs: DataFrame, path_a: str, path_b: str, size: int = CHUNK) -> DataFrame:
    rows = stored(chunks(docs, path_a, path_b, size), "aligned")
    pairs = rows.where("codes is not null").select("chunk", F.inline(F.arrays_zip("codes", "counts"))).toDF("chunk", "code", "n")
    counted = pairs.drop("n").join(pair_counts(pairs.select("code", "n")), "code").select("chunk", "code", "count", "best")
    # A chunk's row is told from those of documents by a mark, so that the pairs themselves don't travel again.
    slim = rows.withColumn("of_pairs", F.when(F.col("codes").isNotNull(), 1)).drop("codes", "counts")
    return slim.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(_sum_up, ALIGNED)


def pair_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """id_a, id_b, count, best: the alignment of the two vocabularies over all documents."""
    rows = chunks(docs, path_a, path_b).where("codes is not null")
    counts = pair_counts(rows.select(F.inline(F.arrays_zip("codes", "counts"))).toDF("code", "n"))
    return counts.select(
        F.shiftrightunsigned("code", 16).alias("id_a"), F.col("code").bitwiseAND(0xFFFF).alias("id_b"), "count", "best")
