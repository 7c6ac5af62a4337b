"""Alignment of two tokenizers over the same texts: a byte-level BPE (A) and sentence pieces with byte fallback (B).

A text is encoded by both with a space in front. The spans that the libraries report are the coarse cuts: character offsets
of A, and the proto spans of B. Where they cannot say where a token ends (A's tokens inside one multibyte character share
its offsets, B's byte tokens have no span but the last) the decoded bytes of the tokens do. Bytes at which a token of both
ends cut the text into groups; all tokens of A and all of B in a group are linked.

No token of either crosses the boundary before a single space between two words: A's pattern starts a new piece there, and
no piece of B goes on after a space (looked up in its vocabulary; with one that does, texts are taken whole). So every
different word with its space is encoded and aligned once in a while, and a text is put together from its words.

Pairs are counted by blocks of texts: a block hands on each of its pairs once, with its documents. The totals come back to
the block by a join on pair and block; no row for each document and pair is ever moved.
"""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.llm.common import keep, raw, slices

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text in a block, longer texts alone; words and characters remembered before the memory starts anew.
BLOCK_BYTES = 4 << 20
MEMO_WORDS, MEMO_CHARS = 300_000, 8 << 20
#: Characters encoded in one call.
CALL_CHARS = 1 << 16
#: Links of a group that are listed one by one; larger groups are counted by id.
LISTED = 64

def byte_letters() -> dict[str, int]:
    """The letters byte-level vocabularies write bytes with: printable ones stand for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Both tokenizers, and what is known about the words met so far."""

    def __init__(self, a_file: str, b_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        letters, added = byte_letters(), self.a.get_added_tokens_decoder()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if i in added else bytes(letters[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.wide = len(pieces)
        self.a_size, self.b_size = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        most = max(len(self.a_bytes), self.wide)
        self.digits_of = np.array([len(str(i)) for i in range(most)])
        wide = int(self.digits_of[-1])
        padded = "".join(str(i).ljust(wide + 1) for i in range(most)).encode()
        self.digits = np.frombuffer(padded, np.uint8).reshape(most, wide + 1)
        # A normalizer might look across the boundary.
        probes = (" a  b ", " \u0301a", "\ufb01 \u01fa", "e\u0301 \uff41", "\u00a8\u3000\u2460")
        plain = all(self.b.normalize(s) == "▁" + s.replace(" ", "▁") for s in probes)
        self.apart = plain and not any("▁" in p.lstrip("▁") for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.chars = 0
        self.counts = [np.zeros((0, 4), np.int64)]  # tokens of A, of B, groups, links of each word
        self.written: list[bytes | None] = []  # None: the bytes do not come back
        self.first = [np.zeros(1, np.int64)]  # where a word's pairs end
        self.pairs, self.times = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]  # numbers of pairs, and how often
        self.pair_numbers: dict[int, int] = {}
        self.heavy = False  # a word holds a pair more than once in an entry

    def words(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of all texts, each with the space in front, and where each text's begin."""
        data, at = raw(pc.binary_join_element_wise(pa.scalar(" "), texts.fill_null(""), ""))
        starts = at[:-1]
        if self.apart:
            space = np.flatnonzero(data == 32)
            padded = np.concatenate([[0, 0, 0], data, [0, 0, 0]])
            cut = space[~_blank_before(padded, space + 3) & ~_blank_after(padded, space + 4)]
            mark = np.zeros(len(data), bool)
            mark[starts], mark[cut] = True, True
            starts = np.flatnonzero(mark)
        edge = np.append(starts, len(data)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edge), pa.py_buffer(data))
        return words.dictionary_encode(), np.searchsorted(starts, at)

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The words of the texts as numbers of what is known about them, and where each text's begin."""
        if len(self.memo) > MEMO_WORDS or self.chars > MEMO_CHARS:
            self.forget()
        words, begin = self.words(texts)
        different = words.dictionary.to_pylist()
        part, size = [], 0
        for w in different:
            if w not in self.memo:
                part.append(w)
                size += len(w)
                if size >= CALL_CHARS:
                    self.learn(part)
                    part, size = [], 0
        if part:
            self.learn(part)
        number = np.fromiter((self.memo[w] for w in different), np.int64, len(different))
        for name in ("counts", "first", "pairs", "times"):
            setattr(self, name, [np.concatenate(getattr(self, name))])
        return number[words.indices.to_numpy()], begin

    def learn(self, words: list[str]) -> None:
        """Encode and align words not met before, all at once."""
        number = np.arange(len(words)) + len(self.written)
        self.memo.update(zip(words, number.tolist(), strict=True))
        self.chars += sum(map(len, words))
        # Words that begin and end without white space tokenize in a row as they do alone; the rest goes one by one.
        plain = [self.apart and not w[1:2].isspace() and not w[-1:].isspace() and "▁" not in w for w in words]
        kept = np.flatnonzero(plain)
        found = self.together([words[k] for k in kept]) if len(kept) else None
        if found is None:
            kept, found = self.one_by_one(words)
        elif len(kept) < len(words):
            rest = np.flatnonzero(~np.array(plain))
            places, more = self.one_by_one([words[k] for k in rest])
            shift = [0, len("".join(words[k] for k in kept)), 0, found[3][-1]]
            kept = np.concatenate([kept, rest[places]])
            found = [np.concatenate([x, y + d] if i < 3 else [x, y[1:] + d]) for i, (x, y, d) in enumerate(zip(found, more, shift, strict=True))]
        self.align([words[k] for k in kept], kept, len(words), *found)

    def together(self, words: list[str]) -> list[np.ndarray] | None:
        """Ids of A, their character spans, ids and ends of B, and byte edges of words encoded in a row; None if bytes differ."""
        text = "".join(words)
        a, b = self.a.encode(text, add_special_tokens=False), self.spans_of_b([text[1:]])[0]
        if b"".join([self.a_bytes[i] for i in a.ids]) != text.encode() or b"".join([self.b_bytes[i] for i in b["ids"]]) != text.encode():
            return None
        return self.arrays([a.ids], [a.offsets], [0], [b], [0], words)

    def one_by_one(self, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The words whose bytes come back, and for those the same as `together`."""
        a, b = self.a.encode_batch(words, add_special_tokens=False), self.spans_of_b([w[1:] for w in words])

        def whole(k: int, word: str) -> bool:
            mine, theirs = a[k].ids, b[k]["ids"]
            text = word.encode()
            return bool(theirs) and b"".join([self.a_bytes[i] for i in mine]) == text == b"".join([self.b_bytes[i] for i in theirs])

        kept = [k for k, w in enumerate(words) if whole(k, w)]
        chars = np.cumsum([0] + [len(words[k]) for k in kept])
        size = np.cumsum([0] + [len(words[k].encode()) for k in kept])
        mine, theirs = [a[k] for k in kept], [b[k] for k in kept]
        ids, spans = [x.ids for x in mine], [x.offsets for x in mine]
        return np.array(kept, np.int64), self.arrays(ids, spans, chars, theirs, size, [words[k] for k in kept])

    def spans_of_b(self, texts: list[str]) -> list[dict]:
        """Ids and spans in bytes; the spans are those of the library's proto, without a Python object for each piece."""
        return self.b.encode(texts, return_type="offset_mapping", return_bytes=True, num_threads=1)

    @staticmethod
    def arrays(ids, spans, chars, pieces, size, words: list[str]) -> list[np.ndarray]:
        flat = chain.from_iterable
        a_ids = np.fromiter(flat(ids), np.int64)
        a_spans = np.fromiter(flat(flat(spans)), np.int64).reshape(-1, 2)
        a_spans += np.repeat(chars[: len(ids)], [len(x) for x in ids])[:, None] if len(ids) else 0
        b_ids = np.fromiter(flat(p["ids"] for p in pieces), np.int64)
        b_ends = np.fromiter((end for p in pieces for _, end in p["offsets"]), np.int64) + 1
        b_ends += np.repeat(size[: len(pieces)], [len(p["ids"]) for p in pieces]) if len(pieces) else 0
        edges = np.cumsum([0] + [len(w.encode()) for w in words])
        return [a_ids, a_spans, np.stack([b_ids, b_ends], 1), edges]

    def align(self, words: list[str], kept: np.ndarray, every: int, a_ids: np.ndarray, a_spans: np.ndarray, b: np.ndarray, base: np.ndarray) -> None:
        b_ids, b_ends = b[:, 0], b[:, 1]
        a_ends = self.ends_of_a("".join(words).encode(), a_ids, a_spans)
        b_ends = self.ends_of_b(b_ids, b_ends)
        a_cut, b_cut = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        groups = int(a_cut.sum())
        a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_past, b_past = np.cumsum(a_in), np.cumsum(b_in)
        # As many links in a word as its groups have; a word ends a group.
        group_word = np.searchsorted(base[1:], a_ends[a_cut], "left")
        many = len(kept)
        a_many = np.diff(np.searchsorted(a_ends, base, "right"))
        b_many = np.diff(np.searchsorted(b_ends, base, "right"))
        counts = np.zeros((every, 4), np.int64)
        counts[kept, 0], counts[kept, 1] = a_many, b_many
        counts[kept, 2] = np.bincount(group_word, minlength=many)
        np.add.at(counts[:, 3], kept[group_word], a_in * b_in)
        self.counts.append(counts)
        written = self.write(a_ids, b_ids, a_group, b_group, a_cut, b_cut, a_past, b_past, a_many + b_many)
        out: list[bytes | None] = [None] * every
        for k, w in zip(kept.tolist(), written, strict=True):
            out[k] = w
        self.written += out
        # Links of small groups one by one, of large ones by the ids in them.
        small = a_in * b_in <= LISTED
        mine = np.flatnonzero(small[a_group])
        reach = b_in[a_group[mine]]
        theirs = np.repeat(b_past[a_group[mine]] - np.cumsum(reach), reach) + np.arange(int(reach.sum()))
        pairs = [np.repeat(a_ids[mine], reach) * self.wide + b_ids[theirs]]
        word, times = [np.repeat(group_word[a_group[mine]], reach)], [np.ones(len(pairs[0]), np.int64)]
        for g in np.flatnonzero(~small):
            x, n = np.unique(a_ids[a_past[g] - a_in[g] : a_past[g]], return_counts=True)
            y, m = np.unique(b_ids[b_past[g] - b_in[g] : b_past[g]], return_counts=True)
            pairs.append((x[:, None] * self.wide + y).ravel())
            times.append(np.outer(n, m).ravel())
            word.append(np.full(len(pairs[-1]), group_word[g]))
        word = kept[np.concatenate(word)]
        order = np.argsort(word, kind="stable")
        different, at = np.unique(np.concatenate(pairs)[order], return_inverse=True)
        known = self.pair_numbers
        self.pairs.append(np.array([known.setdefault(p, len(known)) for p in different.tolist()], np.int32)[at])
        self.times.append(np.concatenate(times)[order].astype(np.int32))
        self.heavy |= bool((self.times[-1] > 1).any())
        self.first.append(sum(map(len, self.pairs[:-1])) + np.cumsum(np.bincount(word, minlength=every)))

    def ends_of_a(self, text: bytes, ids: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Byte at which each token ends: its character offset, or its bytes where the next token is in the same character."""
        data = np.frombuffer(text, np.uint8)
        at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        inside = np.append(spans[1:, 0] < spans[:-1, 1], False)
        return np.where(inside, np.cumsum(self.a_size[ids]), at[spans[:, 1]])

    def ends_of_b(self, ids: np.ndarray, spans: np.ndarray) -> np.ndarray:
        """Byte at which each piece ends: its span, or its bytes where the span of a byte token stays behind."""
        decoded = np.cumsum(self.b_size[ids])
        return np.where(spans == decoded, spans, decoded)

    def write(self, a_ids, b_ids, a_group, b_group, a_cut, b_cut, a_past, b_past, many) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3;` for each word: the numbers of all words in one go, then cut by word."""
        n, m = len(a_ids), len(b_ids)
        before = np.concatenate([[0], b_past])
        a_at, b_at = np.arange(n) + before[a_group], np.arange(m) + a_past[b_group]
        ids, mark = np.empty(n + m, np.int64), np.empty(n + m, np.uint8)
        ids[a_at], ids[b_at] = a_ids, b_ids
        mark[a_at], mark[b_at] = np.where(a_cut, ord("|"), ord(",")), np.where(b_cut, ord(";"), ord(","))
        length = self.digits_of[ids]
        out = self.digits[ids]
        out[np.arange(n + m), length] = mark
        flat = out[np.arange(out.shape[1]) <= length[:, None]].tobytes()
        past = np.concatenate([[0], np.cumsum(length + 1)])
        edge = past[np.concatenate([[0], np.cumsum(many)])].tolist()
        return [flat[i:j] for i, j in zip(edge[:-1], edge[1:], strict=True)]


def _blank_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before these places is white space of any kind."""
    one, two, three = data[at - 1], data[at - 2], data[at - 3]
    return _BLANK[one] | (two == 0xC2) & _C2[one] | _blank_of_three(three, two, one)


def _blank_after(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character at these places is white space, or nothing."""
    one, two, three = data[at], data[at + 1], data[at + 2]
    return _BLANK[one] | (one == 0xC2) & _C2[two] | _blank_of_three(one, two, three)


def _blank_of_three(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    code = one.astype(np.int32) << 16 | two.astype(np.int32) << 8 | three
    return np.isin(code, _THREE)


# White space in UTF-8: single bytes (0 pads the ends), second bytes after C2, and characters of three bytes.
_BLANK, _C2 = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0, *range(9, 14), *range(28, 33)]] = True
_C2[[0x85, 0xA0]] = True
_THREE = [int.from_bytes(chr(c).encode()) for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


@lru_cache(maxsize=2)
def aligner(a_file: str, b_file: str) -> Aligner:
    """One for each worker process."""
    return Aligner(a_file, b_file)


class Block:
    """What the texts of a block come to."""

    def __init__(self, known: Aligner, texts: pa.Array):
        number, begin = known.numbered(texts)
        rows = len(texts)
        text = np.repeat(np.arange(rows), np.diff(begin))
        lost = np.array([w is None for w in known.written])[number]
        bad = np.bincount(text[lost], minlength=rows) > 0
        empty = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False) == 0
        self.clean = ~bad & ~empty
        names = number.tolist()
        self.written = [
            b"".join([known.written[k] for k in names[i:j]])[:-1] if ok else b""
            for ok, i, j in zip(self.clean.tolist(), begin[:-1].tolist(), begin[1:].tolist(), strict=True)
        ]
        run = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(known.counts[0][number], axis=0)])
        self.counts = np.where(self.clean[:, None], run[begin[1:]] - run[begin[:-1]], 0)
        used = self.clean[text]
        self.link(known, text[used], number[used], rows)

    def link(self, known: Aligner, text: np.ndarray, word: np.ndarray, rows: int) -> None:
        """The pairs of the block, in how many texts each is, and for each text its pairs (`at`) and how often (`times`)."""
        first, many = known.first[0], max(1, len(known.pair_numbers))
        length = first[word + 1] - first[word]
        flat = np.repeat(first[word] - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
        held = np.repeat(text * many, length) + known.pairs[0][flat]
        met, self.times = np.unique(held, return_counts=True)
        if known.heavy:
            more = known.times[0][flat]
            heavy = np.flatnonzero(more > 1)
            np.add.at(self.times, np.searchsorted(met, held[heavy]), more[heavy] - 1)
        text, at = np.divmod(met, many)
        docs = np.bincount(at, minlength=many)
        # Numbers within the block, in the order in which the pairs were first met.
        self.pairs = np.flatnonzero(docs)
        self.docs = docs[self.pairs]
        place = np.zeros(many, np.int64)
        place[self.pairs] = np.arange(len(self.pairs))
        self.at = place[at]
        names = np.fromiter(known.pair_numbers, np.int64, len(known.pair_numbers))
        self.pairs = names[self.pairs]
        self.begin = np.searchsorted(text, np.arange(rows + 1))


def _texts(batch: pa.RecordBatch):
    """Blocks of a batch: its rows, and their texts; a key may be missing, the text comes last."""
    column = batch.column(batch.num_columns - 1)
    for i, j in slices(column, BLOCK_BYTES):
        yield batch.slice(i, j - i), column.slice(i, j - i)


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """The key and `groups` of every row: begin and end byte (the space in front counts) and the ids of both tokenizers.

    A text that is NULL, empty or does not come back from the tokens of either has no groups. Rows that share a key, or have
    none, are rows of their own. No other column is read.
    """
    source = docs.select(F.col(key).alias(key), F.col(text).alias("__text"))
    kind = "array<struct<begin:bigint,end:bigint,a:array<int>,b:array<int>>>"

    def listed(written: bytes, known: Aligner) -> list[dict]:
        out, past = [], 0
        for group in written.split(b";") if written else ():
            a, b = ([*map(int, ids.split(b","))] for ids in group.split(b"|"))
            end = past + sum(len(known.a_bytes[i]) for i in a)
            out.append({"begin": past, "end": end, "a": a, "b": b})
            past = end
        return out

    def run(batches):
        known = aligner(a_file, b_file)
        item = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
        for batch in batches:
            for rows, texts in _texts(batch):
                found = [listed(w, known) for w in Block(known, texts).written]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.list_(item))], [key, "groups"])

    return source.mapInArrow(run, f"`{key}` {source.schema[0].dataType.simpleString()}, groups {kind}")


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """For every row the key, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    The count of a pair is the number of rows that hold it linked; `n_best` counts the links whose pair has the highest count
    of all pairs with the same id of A, ties included. Odd rows are as in `groups`: without tokens all numbers are 0 and the
    digest is empty. Rows that share a key count as often as they occur. An empty table gives an empty result.
    """
    source = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"))
    kind = source.schema[0].dataType.simpleString()
    counted = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
    lists = "at array<int>, times array<bigint>, pairs array<bigint>, docs array<int>"

    def encode(batches):
        known, number = aligner(a_file, b_file), 0
        task = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows, texts in _texts(batch):
                block, n = Block(known, texts), len(texts)
                # The pairs of a block go with its first row.
                edge = pa.array([0, len(block.pairs)] + [len(block.pairs)] * (n - 1), pa.int32())
                digests = [hashlib.sha256(w).hexdigest() if w else "" for w in block.written]
                begin = pa.array(block.begin.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, task + number)),
                        rows.column(0),
                        *(pa.array(block.counts[:, k].copy()) for k in range(4)),
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(begin, pa.array(block.at.astype(np.int32))),
                        pa.ListArray.from_arrays(begin, pa.array(block.times)),
                        pa.ListArray.from_arrays(edge, pa.array(block.pairs)),
                        pa.ListArray.from_arrays(edge, pa.array(block.docs.astype(np.int32))),
                    ],
                    ["block", "__key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times", "pairs", "docs"],
                )
                number += 1

    blocks = keep(source.mapInArrow(encode, f"block long, __key {kind}, {counted}, groups_sha256 string, {lists}"), "tokenalign")
    listed = blocks.where(F.size("pairs") > 0).select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("k", "p"))
    listed = listed.select("block", "k", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    wide = aligner(a_file, b_file).wide
    total = listed.groupBy("pair").agg(F.sum("docs").alias("total")).withColumn("a", F.expr(f"pair div {wide}"))
    # At most a row for each id of A.
    top = total.groupBy("a").agg(F.max("total").alias("top"))
    total = total.join(F.broadcast(top), "a").select("pair", "total", (F.col("total") == F.col("top")).alias("best"))
    back = listed.select("block", "k", "pair").join(total, "pair").select(F.col("block").alias("of"), "k", "total", "best")

    def judge(rows: pa.Table, totals: pa.Table) -> pa.Table:
        at = rows["at"].combine_chunks()
        begin = at.offsets.to_numpy().astype(np.int64)
        place = at.flatten().to_numpy()
        times = rows["times"].combine_chunks().flatten().to_numpy()
        many = int(place.max(initial=-1)) + 1
        total, best = np.zeros(many, np.int64), np.zeros(many, bool)
        k = totals["k"].to_numpy()
        total[k], best[k] = totals["total"].to_numpy(), totals["best"].to_numpy()

        def by_row(values: np.ndarray) -> pa.Array:
            run = np.concatenate([[0], np.cumsum(values)])
            edge = begin - begin[0]
            return pa.array(run[edge[1:]] - run[edge[:-1]])

        columns = [rows[c] for c in ("__key", "n_a", "n_b", "n_groups", "n_links")]
        columns += [by_row(times * best[place]), by_row(times * total[place]), rows["groups_sha256"]]
        return pa.table(columns, ["__key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    columns = f"__key {kind}, {counted}, n_best bigint, count_sum bigint, groups_sha256 string"
    out = blocks.drop("pairs", "docs").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(judge, columns)
    return out.withColumnRenamed("__key", key)
