"""BPE encoding and decoding by one walk over a trie of distinct words.

A prefix of a word has one encoding, so one last token; the encoding of a longer prefix
ends in the one token whose left neighbour, the last token of the prefix before it, may
stand beside it. (Two tokens may stand side by side when encoding their joined text gives
back just the two; a sequence in which all neighbours may is the encoding of its text.)
So a trie node needs its last token only. The distinct words of a batch in sorted order
are their trie in depth-first order: the walk keeps the last tokens along the path, goes
back to where the next word branches off, and goes on from there. What words share in
front is encoded once.

The tokenizer is that of a tokenizers-library file: NFC, white space to blanks, lower case;
a pattern's matches as words; bytes as characters; merges, the last character of a word
carrying the end-of-word suffix. Decoding, as no decoder is named, joins tokens by blanks.

Nulls and empty texts have no tokens. Rows are independent: repeated rows repeat their result, null ids
stay null, an empty table has no rows, other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fabula.llm.memory import releasing, small_batches

#: Entries of a task's caches: encoded stretches between blanks, and token pairs looked at.
CACHE, PAIRS = 450_000, 300_000
OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
OUT_FULL = "doc_id long, n_tokens long, ids array<int>, decoded string"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    out = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [out[b] for b in range(256)]


class TrieBpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.by_id = [self.names.get(i, "") for i in range(max(self.names) + 1)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.by_line = regex.compile(r"\n|" + self.pattern.pattern)
        self.byte_table = dict(enumerate(byte_characters()))
        end = self.suffix
        self.inner = {t: i for t, i in vocab.items() if not t.endswith(end) or t == end}
        self.final = {t.removesuffix(end): i for t, i in vocab.items() if t.endswith(end) and t != end}
        self.inner_sizes, self.final_sizes = self.sizes(self.inner), self.sizes(self.final)
        self.left, self.right, self.rank, self.pairs = {}, {}, {}, {}
        for k, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            i, j = vocab[a], vocab[b]
            t = vocab[a + b]
            if t not in self.rank:
                self.left[t], self.right[t], self.rank[t] = i, j, k
            self.pairs.setdefault((i, j), k)
        self.beside: dict[int, bool] = {}  # left << 20 | right

    @staticmethod
    def sizes(tokens: dict[str, int]) -> dict[str, list[int]]:
        """Sizes of the tokens that end in two given characters, largest first; one character may always be tried."""
        out: dict[str, set[int]] = {}
        for t in tokens:
            if len(t) > 1:
                out.setdefault(t[-2:], set()).add(len(t))
        return {k: [*sorted(v, reverse=True), 1] for k, v in out.items()}

    def may_stand(self, a: int, b: int) -> bool:
        """Whether token b may follow token a, from the merges that made them, last first: no pair along their common edge may have merged before its parts were taken up."""
        known = self.beside.get(a << 20 | b)
        if known is not None:
            return known
        x, y, limit, out = a, b, 1 << 60, True
        while True:
            merged = self.pairs.get((x, y))
            if merged is not None and merged < limit:
                out = False
                break
            rx, ry = self.rank.get(x, -1), self.rank.get(y, -1)
            if rx < 0 and ry < 0:
                break
            if rx > ry:  # x was made later: before that its right part stood beside y
                limit, x = rx, self.right[x]
            else:  # y was; and of two equal merges the left one comes first
                limit, y = ry + 1, self.left[y]
        if len(self.beside) > PAIRS:
            self.beside.clear()
        self.beside[a << 20 | b] = out
        return out

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """words: distinct, in byte characters. One depth-first walk."""
        out, last, before = {}, [-1], ""
        inner, final, may, beside, one = self.inner, self.final, self.may_stand, self.beside, [1]
        inner_sizes, final_sizes = self.inner_sizes, self.final_sizes
        for w in sorted(words):
            n, k, m = len(w), 0, min(len(w), len(before))
            while k < m and w[k] == before[k]:
                k += 1
            del last[k + 1 :]
            for i in range(len(last), n):
                for size in inner_sizes.get(w[i - 2 : i], one) if i > 1 else one:
                    j = i - size
                    if j >= 0 and (t := inner.get(w[j:i])) is not None:
                        if j == 0:
                            break
                        ok = beside.get(last[j] << 20 | t)
                        if ok or ok is None and may(last[j], t):
                            break
                last.append(t)
            for size in final_sizes.get(w[n - 2 :], one) if n > 1 else one:
                j = n - size
                if j >= 0 and (t := final.get(w[j:])) is not None:
                    if j == 0:
                        break
                    ok = beside.get(last[j] << 20 | t)
                    if ok or ok is None and may(last[j], t):
                        break
            ids = [t]
            while j:
                ids.append(t := last[j])
                j -= self.size(t)
            out[w] = tuple(reversed(ids))
            before = w
        return out

    def size(self, token: int) -> int:
        return len(self.names[token])

    def in_bytes(self, word: str) -> str:
        """A word in byte characters."""
        return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.byte_table)

    def encode_raw(self, words: set[str]) -> dict[str, tuple[int, ...]]:
        forms = {w: self.in_bytes(w) for w in words}
        ids = self.encode_words(list(set(forms.values())))
        return {w: ids[f] for w, f in forms.items()}

    def normal(self, text: str) -> str:
        """NFC, then lower case, each character by itself: no final sigma. White space is left to the pattern."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def encode_stretches(self, new: list[str], words: dict[str, tuple[int, ...]]) -> Iterator[tuple[str, list[int]]]:
        """Ids of texts without blanks or line ends. words: what is known, grows."""
        marked = [s for s in new if "<|" in s and any(x in s for x in self.special)]
        plain = [s for s in new if s not in set(marked)] if marked else new
        if plain:
            found = self.by_line.findall(self.normal("\n".join(plain)))  # all at once; a line end closes a stretch
            words |= self.encode_raw(set(found) - words.keys() - {"\n"})
            ids, at = [], iter(plain)
            for w in found:
                if w == "\n":
                    yield next(at), ids
                    ids = []
                else:
                    ids.extend(words[w])
            yield next(at), ids
        for s in marked:
            ids = []
            for part in self.split_special.split(s):
                if part in self.special:
                    ids.append(self.special[part])
                else:
                    found = self.pattern.findall(self.normal(part))
                    words |= self.encode_raw(set(found) - words.keys())
                    ids.extend(i for w in found for i in words[w])
            yield s, ids


@functools.lru_cache(2)
def loaded(path: str) -> TrieBpe:
    return TrieBpe(path)


_BLANKS = str.maketrans("\t\n\r", "   ")


def encoded(path: str | None, batches: Iterator[pa.RecordBatch], full: bool, piece: int = 500) -> Iterator[pa.RecordBatch]:
    bpe = loaded(path or tokenizer_path())
    ids_of: dict[str, bytes] = {"": b""}
    words: dict[str, tuple[int, ...]] = {}
    for whole in batches:
        for k in range(0, whole.num_rows, piece):
            b = whole.slice(k, piece)
            texts = [x.translate(_BLANKS).split(" ") if x else [] for x in b.column("text").to_pylist()]
            if len(ids_of) > CACHE:
                ids_of, words = {"": b""}, {}
            for s, ids in bpe.encode_stretches(sorted(set().union(*texts).difference(ids_of)), words):
                ids_of[s] = struct.pack(f"<{len(ids)}I", *ids)
            count, one, two = [], [], []
            for t in texts:
                raw = b"".join(map(ids_of.__getitem__, t))
                ids = struct.unpack(f"<{len(raw) // 4}I", raw)
                text = " ".join(map(bpe.by_id.__getitem__, ids))
                count.append(len(ids))
                one.append(list(ids) if full else hashlib.sha256(raw).hexdigest())
                two.append(text if full else hashlib.sha256(text.encode()).hexdigest())
            names = ("ids", "decoded") if full else ("ids_sha256", "decoded_sha256")
            yield pa.record_batch({"doc_id": b.column("doc_id").cast(pa.int64()), "n_tokens": pa.array(count, pa.int64()), names[0]: pa.array(one, pa.list_(pa.int32()) if full else pa.string()), names[1]: pa.array(two, pa.string())})


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def trie_bpe(docs: DataFrame, path: str | None = None, full: bool = False) -> DataFrame:
    """docs: doc_id, text; path: of a tokenizer file on every machine, by default the one that is installed there. Digests of ids and decoded text, or with full both themselves."""
    return small_batches(docs).select("doc_id", "text").mapInArrow(releasing(lambda it: encoded(path, it, full)), OUT_FULL if full else OUT)


def op6_trie_bpe(spark, sf_dir: str) -> DataFrame:
    return trie_bpe(spark.read.parquet(f"{sf_dir}/documents.parquet"))
