"""Byte-pair encoding by a depth-first walk over the words' shared prefixes, and decoding.

An encoding is right exactly if each two neighbouring tokens would also stand side by
side when only their own characters were encoded. So the encoding of a prefix is known
from its last token alone: of the tokens that end the prefix, the right one is the one
that is compatible with the last token of what stands before it. The distinct words of
a chunk, in sorted order, are a trie in depth-first order: the characters a word shares
with the word before keep their states, and only the rest is computed.

Spark deals the rows out; each task holds one chunk of texts and a bounded cache.
"""

import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lower-case forms in newer Unicode tables than Python's, as (first, last, lower of first).
NEWER_LOWER = (
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x0264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x019B),
    (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
)
LOWER = {first + i: lower + i for first, last, lower in NEWER_LOWER for i in range(last - first + 1)}
SPECIAL_LOWER = regex.compile("[Σ" + "".join(map(chr, LOWER)) + "]")
LOWER[ord("Σ")] = ord("σ")

# Characters that are letters or numbers in newer Unicode tables, and symbols to the tokenizer.
LATER_ASSIGNED = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 "
    "1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
LATER_CLASS = "[" + "".join(
    "-".join(chr(int(end, 16)) for end in part.split("-")) for part in LATER_ASSIGNED.split()) + "]"

CHUNK_CHARS = 2_000_000
CACHED_WORDS = 300_000
CACHED_PIECES = 300_000


def byte_symbols():
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    other = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}


class Vocabulary:
    """The parts of a tokenizer file that encoding and decoding need."""

    def __init__(self, path):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids = model["vocab"]
        self.suffix = model["end_of_word_suffix"]
        self.ranks = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = [""] * (max([*self.ids.values(), *self.added.values()]) + 1)
        for name, i in [*self.ids.items(), *self.added.items()]:
            self.names[i] = name
        # Inner tokens by their characters, last tokens of a word by theirs without the suffix.
        self.inner = {n: i for n, i in self.ids.items() if not n.endswith(self.suffix)}
        self.final = {n[: -len(self.suffix)]: i for n, i in self.ids.items() if n.endswith(self.suffix)}
        self.longest_inner = max(map(len, self.inner))
        self.longest_final = max(map(len, self.final))
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = steps[0]["pattern"]["Regex"]
        self._ascii_words = regex.compile(pattern).findall
        for kind in (r"\p{L}", r"\p{N}"):
            pattern = pattern.replace(kind, f"[{kind}--{LATER_CLASS}]")
        self._any_words = regex.compile("(?V1)" + pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.symbols = byte_symbols()
        self._own, self._pairs = {}, {}

    def merged(self, symbols):
        """Tokens of a sequence of symbols by plain merging; only for pairs of tokens."""
        parts = list(symbols)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ids[p] for p in parts]

    def _symbols(self, token):
        name = self.names[token]
        if name.endswith(self.suffix) and len(name) > len(self.suffix):
            body = name[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(name)

    def reached(self, token):
        """Whether the token's own characters are encoded as the token."""
        if token not in self._own:
            self._own[token] = self.merged(self._symbols(token)) == [token]
        return self._own[token]

    def compatible(self, left, right):
        """Whether the characters of both, encoded together, give these two tokens."""
        key = left << 20 | right
        if key not in self._pairs:
            if len(self._pairs) > 2_000_000:
                self._pairs.clear()
            self._pairs[key] = self.merged(self._symbols(left) + self._symbols(right)) == [left, right]
        return self._pairs[key]

    def _extend(self, word, end, last, tokens, longest):
        """The last token of word[:end] and its length, from the last tokens of its prefixes."""
        for size in range(min(end, longest), 0, -1):
            token = tokens.get(word[end - size : end])
            if token is None:
                continue
            if self.compatible(last[end - size][0], token) if end > size else self.reached(token):
                return token, size
        raise ValueError(f"no encoding of a word of {len(word)} symbols at {end}: {word[max(0, end - longest) : end]!r}")

    def encode_words(self, words):
        """{word: token ids} of distinct words, given as byte symbols.

        A prefix keeps its last token and that token's length only; the ids of a word are
        read from its end backwards.
        """
        found, before, last = {}, "", [None]
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            # last[i] is the end of the encoding of the first i symbols, none of them the word's last.
            del last[shared + 1 :]
            for end in range(len(last), len(word)):
                last.append(self._extend(word, end, last, self.inner, self.longest_inner))
            token, size = self._extend(word, len(word), last, self.final, self.longest_final)
            ids, at = [token], len(word) - size
            while at:
                token, size = last[at]
                ids.append(token)
                at -= size
            found[word] = ids[::-1]
            before = word
        return found

    def split(self, text):
        """The parts of a text as (pieces, None) or (None, id of an added token).

        Pieces are in the form that words are cut from; no word goes beyond one.
        """
        if self.cut is None or "<" not in text:
            return [(self._pieces(text), None)]
        return [(None, self.added[part]) if part in self.added else (self._pieces(part), None)
                for part in self.cut.split(text)]

    def cut_words(self, piece):
        return self._ascii_words(piece) if piece.isascii() else self._any_words(piece)

    def _pieces(self, text):
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if SPECIAL_LOWER.search(text):
                text = text.translate(LOWER)
        return text.lower().replace("\n", " ").split(" ")


@lru_cache(maxsize=2)
def vocabulary(path):
    return Vocabulary(path)


class CachedEncoder:
    """Encodes texts; remembers the ids of a bounded number of words and pieces between spaces."""

    def __init__(self, path):
        self.vocabulary = vocabulary(path)
        self.words, self.pieces = {}, {}

    def encode_words(self, words):
        """{word: ids as bytes} of distinct words."""
        raise NotImplementedError

    def _learn(self, pieces):
        new = pieces - self.pieces.keys()
        if len(self.pieces) + len(new) > CACHED_PIECES:  # only what this chunk needs stays
            self.pieces = {p: self.pieces[p] for p in pieces if p in self.pieces}
        # A run of letters is one word; Python's tables have none of the letters of LATER_ASSIGNED.
        whole = {p for p in new if p.isalpha()}
        cut = self.vocabulary.cut_words
        parts = {p: cut(p) for p in new - whole}
        words = whole.union(*parts.values())
        missing = words - self.words.keys()
        if len(self.words) + len(missing) > CACHED_WORDS:
            self.words = {w: self.words[w] for w in words if w in self.words}
        if missing:
            self.words.update(self.encode_words(missing))
        known = self.words
        self.pieces.update({p: known[p] for p in whole})
        self.pieces.update({p: b"".join([known[w] for w in ws]) for p, ws in parts.items()})

    def encode(self, texts):
        """Ids of each text as little-endian unsigned 32-bit integers, one after the other."""
        split = [self.vocabulary.split(t or "") for t in texts]
        self._learn(set().union(*(pieces for parts in split for pieces, _ in parts if pieces)))
        ids_of = self.pieces.__getitem__
        return [
            b"".join([
                token.to_bytes(4, "little") if pieces is None else b"".join(map(ids_of, pieces))
                for pieces, token in parts
            ])
            for parts in split
        ]

    def decode(self, ids):
        """The text of ids: the tokens' names with spaces between."""
        names = self.vocabulary.names
        return " ".join([names[i] for i in memoryview(ids).cast("I").tolist()])


class Encoder(CachedEncoder):
    """Encodes new words by the walk over their shared prefixes."""

    def encode_words(self, words):
        symbols = self.vocabulary.symbols
        named = {w if w.isascii() and w.isprintable() else "".join([symbols[b] for b in w.encode("utf-8", "replace")]): w for w in words}
        return {named[name]: b"".join([i.to_bytes(4, "little") for i in ids])
                for name, ids in self.vocabulary.encode_words(named).items()}


@lru_cache(maxsize=1)
def encoder(path):
    """The encoder of this worker process; its caches serve task after task."""
    return Encoder(path)


def forget():
    """Frees what this worker process has kept for encoding, for tasks of other operations."""
    encoder.cache_clear()
    vocabulary.cache_clear()


def chunks(batch, column, most=CHUNK_CHARS):
    """Slices of a batch whose texts hold about `most` characters, or one row."""
    texts, start, size = batch.column(column).to_pylist(), 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most or i + 1 == len(texts):
            yield batch.slice(start, i + 1 - start), texts[start : i + 1]
            start, size = i + 1, 0


def _without(df, names):
    return df.select([F.col(f"`{c}`") for c in df.columns if c not in names])


def encoded(df, path, text="text", decode=False):
    """`df` with `ids` (binary, little-endian unsigned 32 bits each) and `n_tokens`.

    With `decode` also `decoded`, the text that the ids stand for, made from the ids.
    A NULL or empty text gives no ids and an empty text. Rows keep all their columns;
    columns of these names are replaced. `path` is a tokenizer file that exists on
    every worker.
    """
    rows = _without(df, ("ids", "n_tokens", "decoded"))
    out = T.StructType(list(rows.schema.fields)).add("ids", "binary").add("n_tokens", "long")
    if decode:
        out = out.add("decoded", "string")

    def run(batches):
        coder = encoder(path)
        for batch in batches:
            for part, texts in chunks(batch, text):
                ids = coder.encode(texts)
                columns = [*part.columns, pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if decode:
                    columns.append(pa.array([coder.decode(x) for x in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return rows.mapInArrow(run, out)


def decoded(df, path, ids="ids"):
    """`df` with `decoded`, the text of binary ids; NULL ids give an empty text."""
    rows = _without(df, ("decoded",))
    out = T.StructType(list(rows.schema.fields)).add("decoded", "string")

    def run(batches):
        coder = encoder(path)
        for batch in batches:
            texts = [coder.decode(x or b"") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=out.names)

    return rows.mapInArrow(run, out)
