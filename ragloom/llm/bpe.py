"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged, so it
is a certain cut: the text on either side encodes independently. The table of
such pairs is read from the vocabulary. Cuts are taken before white space
(where the pre-tokenizer cannot look across either): a text falls into
fragments, distinct fragments are encoded once per worker by the tokenizers
library and the ids are concatenated. Decoding joins the byte strings of the
ids.

Defined cases: null is the empty text with no ids; a text without a certain
cut is one fragment; special tokens written in a text become their ids, as
the library does; texts are read in slices of bounded length cut at certain
cuts; repeated rows and extra columns are no concern of a column function.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragloom.llm.common import release_memory

#: Characters of a text that are split at once.
SLICE_CHARS = 1 << 20
#: Entries and ids a worker keeps before it starts its fragment table anew, and
#: the entries where workers also hold the memory of other stages (about 0.4 KB each).
TABLE_FRAGMENTS, TABLE_IDS = 500_000, 6_000_000
SMALL_TABLE = 100_000
SPACES = " \t\n\r"
#: Characters of texts that the word encoder splits at once, and the words it
#: remembers (about 0.25 KB each).
WORD_CHARS, TABLE_WORDS = 4 << 20, 800_000
#: Letters of its plain words, and closing marks that its pre-tokenizer cuts off as one run.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?)]}#*$%&"
LATIN = "".join(c for c in map(chr, range(0x41, 0x100)) if re.match(f"[{LETTERS}]", c))
#: A Latin word, perhaps after one space or line break, perhaps before closing
#: marks: every pre-tokenizer here cuts it into these three parts.
PLAIN = re.compile("([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable
    Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def token_bytes(tokenizer) -> dict[int, bytes]:
    """Byte string of every id."""
    letters = _byte_letters()
    added = tokenizer.get_added_tokens_decoder()
    out = {}
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        out[i] = token.encode() if i in added else bytes(letters[c] for c in token)
    return out


def forced_pairs(tokens) -> np.ndarray:
    """256 x 256 booleans: the pair lies inside no token."""
    forced = np.ones((256, 256), bool)
    for t in tokens:
        if len(t) > 1:
            b = np.frombuffer(t, np.uint8)
            forced[b[:-1], b[1:]] = False
    return forced


def certain_cuts(forced: np.ndarray) -> tuple[str, str]:
    """(spaces, blocked): texts may be cut before a run of `spaces` after any
    character that is neither one of them nor in the class `blocked`, whose
    last byte may share a token with a space."""
    cut = [ord(c) for c in SPACES]
    while True:
        rest = [b for b in range(128) if b not in cut]
        good = [c for c in cut if forced[rest, c].all()]
        if good == cut:
            break
        cut = good
    bad = {b for b in range(128, 256) if not forced[b, cut].all()}
    blocked = "".join(map(chr, (c for c in range(0x80, 0x10000) if (0x80 | c & 0x3F) in bad)))
    if bad:  # beyond the basic plane: no cut rather than a long class
        blocked += f"{chr(0x10000)}-{chr(0x10FFFF)}"
    return "".join(map(chr, cut)), blocked


class Fragments:
    """Encodes texts by fragments, each distinct fragment once. `spaces`: cut
    before a run of these, unless after a character of `blocked`; `drop`: white
    space makes no ids (nor a fragment); `lower`: the normalizer lower-cases.
    New plain words go straight to the merges of the model, other new fragments
    through the whole tokenizer."""

    def __init__(self, tokenizer, spaces: str, blocked: str = "", drop: bool = False, lower: bool = False,
                 table: int = TABLE_FRAGMENTS):
        self.tokenizer, self.model, self.lower, self.table = tokenizer, tokenizer.model, lower, table
        self.letters = {b: letter for letter, b in _byte_letters().items()}
        s = re.escape(spaces)
        if not spaces:
            self.pattern, self.next = re.compile(r"(?s).+"), None
        else:
            more = rf"(?:(?<=[{blocked}])[{s}]+[^{s}]*)*" if blocked else ""
            self.pattern = re.compile(rf"[^{s}]+" if drop else rf"[{s}]*[^{s}]+{more}|[{s}]+")
            self.next = re.compile(rf"(?<=[^{s}{blocked}])(?=[{s}])")
        self.forget()

    def forget(self) -> None:
        """Start the fragment table anew."""
        self.place: dict[str, int] = {}
        self.known: dict[str, list[int]] = {}
        self.count, self.used = 0, 0
        self.first = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)

    def _learn(self, fragments: list[str]) -> None:
        plain = [PLAIN.fullmatch(f) for f in fragments]
        rest = [f for f, m in zip(fragments, plain, strict=True) if m is None]
        other = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        self._add(fragments, [next(other).ids if m is None else self._plain(*m.groups()) for m in plain])

    def _add(self, fragments: list[str], found: list[list[int]]) -> None:
        total = sum(map(len, found))
        while self.count + len(found) > len(self.first):
            self.first, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.first, self.size))
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        at = slice(self.count, self.count + len(found))
        self.size[at] = sizes
        self.first[at] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + total] = np.fromiter(itertools.chain.from_iterable(found), np.uint32, total)
        self.place.update(zip(fragments, range(self.count, self.count + len(found)), strict=True))
        self.count += len(found)
        self.used += total

    def _plain(self, lead: str, word: str, marks: str) -> list[int]:
        if lead == " ":
            word, lead = " " + word, ""
        key = word.lower() if self.lower else word
        ids = self.known.get(key)
        if ids is None:
            letters = key.encode().decode("latin-1").translate(self.letters)
            ids = self.known[key] = [t.id for t in self.model.tokenize(letters)]
        for part, before in ((lead, True), (marks, False)):
            if part:
                more = self.known.get(part)
                if more is None:
                    more = self.known[part] = self.tokenizer.encode(part, add_special_tokens=False).ids
                ids = more + ids if before else ids + more
        return ids

    def slices(self, text: str):
        lo = 0
        while len(text) - lo > SLICE_CHARS and self.next:
            m = self.next.search(text, lo + SLICE_CHARS)
            if not m:
                break
            yield text[lo:m.start()]
            lo = m.start()
        yield text[lo:]

    def _ids(self, fragments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the fragments one after another, and the running count after each."""
        new = set(fragments).difference(self.place)
        if new and (self.count + len(new) > self.table or self.used > TABLE_IDS):
            self.forget()
            new = set(fragments)
        if new:
            self._learn(list(new))
        at = np.fromiter(map(self.place.__getitem__, fragments), np.int64, len(fragments))
        size = self.size[at]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        where = np.arange(total) + np.repeat(self.first[at] - (end - size), size)
        return self.ids[where], end

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every whole text."""
        out: list[np.ndarray] = []
        held: list[str] = []
        cut: list[int] = []

        def flush():
            ids, end = self._ids(held)
            end = np.concatenate([[0], end])
            out.extend(np.split(ids, end[cut[:-1]]))
            held.clear()
            cut.clear()

        chars = 0
        for t in texts:
            if len(t) > SLICE_CHARS:
                if cut:
                    flush()
                out.append(np.concatenate([self._ids(self.pattern.findall(s))[0] for s in self.slices(t)]))
                chars = 0
                continue
            held += self.pattern.findall(t)
            cut.append(len(held))
            chars += len(t)
            if chars > SLICE_CHARS:
                flush()
                chars = 0
        if cut:
            flush()
        return out


def _gather(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ids that begin at `first`, one after another, and the running count after each."""
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if max(total, len(ids)) < 1 << 31 else np.int64
    return ids[np.arange(total, dtype=kind) + np.repeat((first - (end - size)).astype(kind), size)], end


class SpacedWords(Fragments):
    """Encodes texts whose white space makes no ids and whose normalizer
    lower-cases. Arrow cuts them at ASCII white space and numbers the distinct
    fragments of a batch; of a Latin word with closing marks only the
    lower-cased word and the marks are remembered, so a word is encoded once
    however it is written. Other fragments go the way of `Fragments`."""

    def __init__(self, tokenizer, table: int | None = None):
        super().__init__(tokenizer, SPACES, drop=True, lower=True, table=TABLE_WORDS if table is None else table)

    def _rows(self, *lists: list[str]) -> list[np.ndarray]:
        """Rows of the table for lists of distinct parts: Latin words in lower
        case, then others."""
        at = [np.fromiter(map(self.place.get, x, itertools.repeat(-1)), np.int64, len(x)) for x in lists]
        if self.count + sum(int((a < 0).sum()) for a in at) > self.table or self.used > TABLE_WORDS * 10:
            self.forget()
            at = [np.full(len(x), -1) for x in lists]
        for k, (x, a) in enumerate(zip(lists, at, strict=True)):
            if k > 1:  # the lists before may have brought these parts
                a[:] = [self.place.get(p, -1) for p in x]
            miss = np.flatnonzero(a < 0)
            new = [x[i] for i in miss.tolist()]
            a[miss] = np.arange(self.count, self.count + len(new))
            if k == 0:
                cut, letters = self.model.tokenize, self.letters
                spelt = (x if x.isascii() else x.encode().decode("latin-1").translate(letters) for x in new)
                self._add(new, [[t.id for t in cut(x)] for x in spelt])
            elif new:
                self._learn(new)
                self.known.clear()
        return at

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and how many each has."""
        import pyarrow as pa
        import pyarrow.compute as pc
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        edge = split.offsets.to_numpy()
        flat = split.flatten().dictionary_encode()
        each = flat.dictionary  # the different fragments, each a word and its marks or some other part
        word = pc.utf8_rtrim(each, characters=MARKS)
        plain = pc.match_substring_regex(word, f"^[{LETTERS}]+$")
        marks = pc.utf8_ltrim(each.filter(plain), characters=LATIN).dictionary_encode()
        lower = pc.utf8_lower(word.filter(plain)).dictionary_encode()
        words, others, ends = self._rows(lower.dictionary.to_pylist(), each.filter(pc.invert(plain)).to_pylist(), marks.dictionary.to_pylist())
        plain = plain.to_numpy(zero_copy_only=False)
        parts = np.zeros((len(each), 2), np.int64)
        parts[plain, 0], parts[~plain, 0] = words[lower.indices.to_numpy()], others
        there = np.zeros((len(each), 2), bool)
        there[:, 0] = True
        if len(ends):
            parts[plain, 1], there[plain, 1] = ends[marks.indices.to_numpy()], True  # no mark has no ids
        at = parts[there]
        ids, _ = _gather(self.ids, self.first[at], self.size[at])
        size = np.zeros((len(each), 2), np.int64)
        size[there] = self.size[at]
        size = size.sum(axis=1)
        i = flat.indices.to_numpy()
        ids, end = _gather(ids, (np.cumsum(size) - size)[i], size[i])
        return ids, np.diff(np.concatenate([[0], end])[edge])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every whole text."""
        pieces = [(k, s) for k, t in enumerate(texts) for s in (self.slices(t) if len(t) > SLICE_CHARS else (t,))]
        ids, sizes = [], []
        lo = chars = 0
        for hi, (_, s) in enumerate(pieces, 1):
            chars += len(s)
            if chars > WORD_CHARS or hi == len(pieces):
                a, b = self._batch([x for _, x in pieces[lo:hi]])
                ids.append(a)
                sizes.append(b)
                lo, chars = hi, 0
        if not texts:
            return []
        size = np.bincount([k for k, _ in pieces], np.concatenate(sizes), len(texts)).astype(np.int64)
        return np.split(np.concatenate(ids), np.cumsum(size)[:-1])


_loaded: dict[str, tuple] = {}


def codec(path: str, fragments: int = TABLE_FRAGMENTS) -> tuple[Fragments, list[bytes]]:
    """(encoder, byte strings by id) of a byte-level tokenizer file, once per
    worker; `fragments`: entries of its table."""
    key = f"{path}:{fragments}"
    if key not in _loaded:
        t = load(path)
        table = token_bytes(t)
        encoder = Fragments(t, *certain_cuts(forced_pairs(table.values())), table=fragments)
        _loaded[key] = encoder, [table.get(i, b"") for i in range(max(table) + 1)]
    return _loaded[key]


def decode_bytes(ids: np.ndarray, table: list[bytes]) -> str:
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _strings(column) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def encode(text: Column, path: str) -> Column:
    """Column of token ids (array<int>) of whole texts."""
    @F.arrow_udf("array<int>")
    def ids(column):
        import pyarrow as pa
        found = codec(path)[0].encode(_strings(column))
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        flat = np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return ids(text)


def decode(ids: Column, path: str) -> Column:
    """Column of texts from token ids (array<int>); null ids give null."""
    @F.arrow_udf("string")
    def texts(column):
        import pyarrow as pa
        table = codec(path)[1]
        return pa.array([None if x is None else decode_bytes(np.array(x, np.int64), table) for x in column.to_pylist()], pa.string())

    return texts(ids)


def encode_documents(docs: DataFrame, path: str, columns: list[str], text_col: str = "text") -> DataFrame:
    """`columns` of `docs` with `token_ids` (array<int>) of the whole text, sent
    back in small batches: ids take several times the room of their text."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches):
        import pyarrow as pa
        encoder = codec(path, SMALL_TABLE)[0]
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                found = encoder.encode(_strings(part.column(0)))
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], ids], [*columns, "token_ids"])
        encoder.forget()
        release_memory()

    return docs.select(F.col(text_col), *columns).mapInArrow(run, f"{kinds}, token_ids array<int>")


def round_trip(text: Column, path: str) -> Column:
    """Struct column: n_tokens, ids_sha256 (ids as little-endian unsigned
    32-bit integers), decoded_sha256 (UTF-8 of the decoded text). Encodes and
    decodes whole texts without sending the ids through the JVM."""
    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>")
    def digests(column):
        from hashlib import sha256

        import pyarrow as pa
        encoder, table = codec(path)
        n, a, b = [], [], []
        for ids in encoder.encode(_strings(column)):
            n.append(len(ids))
            a.append(sha256(ids.astype("<u4").tobytes()).hexdigest())
            b.append(sha256(decode_bytes(ids, table).encode()).hexdigest())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                                          ["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)
