"""Exact BPE by dynamic programming over prefixes.

For BPE with ranked merges, the encoding of every prefix of a word ends in one
certain token, and the encoding is that of the prefix before it plus the token.
So for each prefix the tokens of the vocabulary that are its suffixes are tried,
longest first; the right one is the one that may follow the last token of the
prefix before it. Two tokens may stand side by side exactly if merging the two
of them does not make an earlier merge across their border. Following the last
tokens back from the end gives the ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import cached_property, partial

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.workers import importable, kept, lean, texts

CACHED_WORDS = 60_000
CACHED_PAIRS = 300_000
#: Rows whose results are held at once; the ids of an Arrow batch take far more room than its text.
ROWS = 256


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the others for the code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


# Code points that are letters or numbers only since Unicode 17. To the
# vocabulary's own splitter, which knows Unicode 16, they are neither.
LATER = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1"
    "\uab6c-\uab6d\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7"
    "\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1"
    "\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2"
    "\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81"
    "\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2"
    "\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    "\U0003d000-\U0003fc3f"
)


# Capitals that have small letters since Unicode 16 or 17.
NEW_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
    0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
    **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}

# Combining marks of later Unicode versions, which the vocabulary's
# normalizer neither reorders nor composes.
LATER_MARKS = re.compile(
    "([\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c"
    "\U00010d24-\U00010d27\U00010eab-\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50"
    "\U00010f82-\U00010f85\U00011070\U0001133b\U0001145e\U00011839-\U0001183a\U0001193d-\U0001193e"
    "\U00011943\U000119e0\U00011a34\U00011a47\U00011a99\U00011d42\U00011d44-\U00011d45\U00011d97"
    "\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae"
    "\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef]+)"
)


def splitters(pattern: str) -> tuple[regex.Pattern, re.Pattern]:
    """The file's pattern for any text, and a faster one for Latin-1 text."""
    for kind in ("L", "N"):
        pattern = pattern.replace(rf"[\p{{{kind}}}]", rf"[\p{{{kind}}}--[{LATER}]]")
    full = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[[^\s\p{{L}}\p{{N}}]||[{LATER}]]")

    def latin(kind: str) -> str:
        low = [chr(c) for c in range(256)]
        return "".join(re.escape(c) for c in low if unicodedata.category(c).startswith(kind))

    small = pattern
    for kind in ("L", "N"):
        small = small.replace(rf"[\p{{{kind}}}--[{LATER}]]", f"[{latin(kind)}]")
        small = small.replace(rf"\p{{{kind}}}", latin(kind))
    # unlike the file's splitter, re takes the four separators for blanks
    small = small.replace(r"[^\s", "[^\t\n\x0b\x0c\r \x85\xa0")
    return regex.compile(full, regex.V1), re.compile(small)


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordBpe:
    """Encoder and decoder of a word-end BPE vocabulary file.

    A word is a list of symbols, one for each byte, the last with the word-end
    mark. Tokens are handled by id; a symbol is a token too.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = file["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(self.vocab[a], self.vocab[b]): i for i, (a, b) in enumerate(merges)}
        self.merged = {(self.vocab[a], self.vocab[b]): self.vocab[a + b] for a, b in merges}
        # of tokens that a merge makes: its two parts and its rank
        self.parts: dict[int, tuple[int, int, int]] = {}
        for pair, made in self.merged.items():
            self.parts.setdefault(made, (*pair, self.rank[pair]))
        self.specials = {t["content"]: t["id"] for t in file["added_tokens"]}
        pattern = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces, self.latin_pieces = splitters(pattern)
        self.chars = byte_chars()
        self.bytes = {c: b for b, c in enumerate(self.chars)}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[str, int, str]] = {}
        self.older: dict[str, tuple[str, int, str]] = {}

    @cached_property
    def split_specials(self) -> regex.Pattern:
        inner = "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))
        return regex.compile(f"({inner})")

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds every token that ends at a place of a word, in one walk along it.

        Its suffix links lead from the longest match to the shorter ones. Tokens
        that a word cannot be cut into, because their own encoding is not they
        themselves, are left out.
        """
        found = ahocorasick.Automaton()
        for token, number in self.vocab.items():
            inner = token.removesuffix(self.end) if token != self.end else token
            marked = inner + "\0" if token.endswith(self.end) and token != self.end else token
            if len(inner) == 1 or number in self.parts and self.reachable(number):
                found.add_word(marked, (len(inner), number))
        found.make_automaton()
        return found

    def reachable(self, token: int) -> bool:
        """Whether the merges make this token out of its own symbols."""
        if token not in self.parts:
            return True
        left, right, _ = self.parts[token]
        return self.reachable(left) and self.reachable(right) and self.compatible(left, right, self.parts[token][2])

    def compatible(self, left: int, right: int, before: int | None = None) -> bool:
        """Whether the encoding of both texts together keeps the border between them.

        Taking both tokens apart, latest merge first, shows every pair that faces
        the other across the border. The border falls if such a pair has a merge
        that comes before the one that its later made side came from. ``before``:
        the pair itself may merge at that rank, but no earlier.
        """
        limit = len(self.rank) if before is None else before
        rank, parts, symbol = self.rank, self.parts, (-1, -1, -1)
        while True:
            at = rank.get((left, right))
            if at is not None and at < limit:
                return False
            l_first, l_second, l_rank = parts.get(left, symbol)
            r_first, r_second, r_rank = parts.get(right, symbol)
            if l_rank == r_rank == -1:
                return True
            # merges go by rank, and from left to right within one rank
            if l_rank > r_rank:
                limit, left = l_rank, l_second
            else:
                limit, right = r_rank + 1, r_first

    def follows(self, left: int, right: int) -> bool:
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self.compatible(left, right)
        return known

    def encode_symbols(self, symbols: str) -> list[int]:
        """Ids of one word given as its symbols, the word end not marked."""
        n = len(symbols)
        last, sizes = [-1] * (n + 1), [0] * (n + 1)
        pairs = self.pairs
        # matches come by the place where they end, the longest first
        for at, (size, token) in self.automaton.iter(symbols + "\0"):
            i = at + 1
            if i > n:
                i = n
            elif i == n:  # only a token with the word-end mark can be last
                continue
            if last[i] >= 0:
                continue
            before = last[i - size]
            if i == size:
                fits = True
            elif (fits := pairs.get(before << 32 | token)) is None:
                fits = self.follows(before, token)
            if fits:
                last[i], sizes[i] = token, size
        ids = []
        i = n
        while i:
            if last[i] < 0:
                raise ValueError("the vocabulary lacks a symbol")
            ids.append(last[i])
            i -= sizes[i]
        ids.reverse()
        return ids

    def encode_word(self, piece: str) -> list[int]:
        return self.encode_symbols("".join(self.chars[b] for b in piece.encode("utf-8")))

    def known(self, piece: str) -> tuple[str, int, str]:
        """Ids joined by a blank, their number, and the text they decode to."""
        found = self.older.get(piece)
        if found is None:
            ids = self.encode_word(piece)
            found = (" ".join(map(str, ids)), len(ids), self.decode(ids))
        if len(self.words) >= CACHED_WORDS:  # the older half of the words in use stays at hand
            self.older, self.words = self.words, {}
        self.words[piece] = found
        return found

    def normal(self, text: str) -> str:
        """As the file's normalizer, but for blanks, which no word holds. Characters are
        lower-cased one by one, so a final sigma is like any other."""
        if text.isascii():
            return text.lower()
        if is_latin(text):
            return unicodedata.normalize("NFC", text).lower()
        parts = LATER_MARKS.split(text)
        parts[::2] = [unicodedata.normalize("NFC", p) for p in parts[::2]]
        return "".join(parts).replace("\u03a3", "\u03c3").lower().translate(NEW_LOWER)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for joined, _, _ in self.encoded(text):
            ids += map(int, joined.split(" "))
        return ids

    def encoded(self, text: str):
        """Ids joined, number and decoded text of the words of a text, in order."""
        words, known = self.words, self.known
        for part in self.split_specials.split(text):
            if part in self.specials:
                yield str(self.specials[part]), 1, part
            elif part:
                normal = self.normal(part)
                for piece in (self.latin_pieces if is_latin(normal) else self.pieces).findall(normal):
                    yield words.get(piece) or known(piece)

    @cached_property
    def tokens(self) -> dict[int, str]:
        return {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.specials.items()}

    def decode(self, ids: list[int]) -> str:
        """Tokens as the file spells them, joined by a blank: it names no decoder."""
        return " ".join(self.tokens[i] for i in ids)


ENCODED = {
    "n_tokens": "long", "ids": "array<int>", "decoded": "string",
    "ids_sha256": "string", "decoded_sha256": "string",
}
KINDS = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "string": pa.string()}


def _encoded(batches, vocabulary: str, results: tuple[str, ...]):
    """The results of a partition, by an encoder that tasks of this kind keep: it takes a second to make, and some 100 MB."""
    bpe = kept(WordBpe, vocabulary)
    parts = (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS))
    for batch in parts:
        found: dict[str, list] = {name: [] for name in results}
        for value in texts(batch.column("text")):
            words = list(bpe.encoded(value))
            joined = " ".join([w[0] for w in words])
            decoded = " ".join([w[2] for w in words])
            made = {
                "n_tokens": lambda: sum(w[1] for w in words),
                "ids": lambda: np.array(joined.split(), np.int32),
                "decoded": lambda: decoded,
                "ids_sha256": lambda: hashlib.sha256(joined.encode()).hexdigest(),
                "decoded_sha256": lambda: hashlib.sha256(decoded.encode()).hexdigest(),
            }
            for name, values in found.items():
                values.append(made[name]())
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"),
            **{n: pa.array(v, KINDS[ENCODED[n]]) for n, v in found.items()},
        })


def encoded(
    docs: DataFrame,
    vocabulary: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    results: tuple[str, ...] = tuple(ENCODED),
) -> DataFrame:
    """``doc_id`` and the chosen results for every row of ``docs``.

    ``ids`` are the token ids of the whole text, special tokens only where the
    text spells them; ``decoded`` is what they decode to; the digests are SHA-256
    of the ids, decimal and joined by one blank, and of ``decoded``. A null text
    is empty and has no tokens; null ids and repeated rows are documents like
    others; other columns are not looked at; an empty table gives no rows.
    ``vocabulary`` is a file that every worker can read.
    """
    importable(docs.sparkSession)
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    schema = ", ".join([f"doc_id {kind}", *(f"{n} {ENCODED[n]}" for n in results)])
    return source.mapInArrow(lean(partial(_encoded, vocabulary=vocabulary, results=results), keeps=True), schema)


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encoded(
        docs,
        public_tokenizers.path("word_bpe_49k.json"),
        results=("n_tokens", "ids_sha256", "decoded_sha256"),
    )
