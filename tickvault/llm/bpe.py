"""BPE encoding and decoding by a trie over distinct words.

A prefix of a word encodes to a prefix-closed state: its last token. For each node of the trie there is exactly one
token that ends the node's string and follows the last token of the node where it begins as a valid pair, that is, a
pair which merges leave apart. Distinct words are taken in sorted order, which is a depth-first walk of their trie, so
the states of a shared prefix are computed once; a word's ids are read back from its node to the root.

Defined results: a null text is the empty text, with no ids; repeated rows and null ids are rows like any other;
columns other than the id and the text are not passed on. Texts outside Latin letters are cut into words by the
library's own pre-tokenizer; special tokens inside a text get their id, as in the library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickvault.llm.common import table
from tickvault.llm.tokens import BEYOND, PIECES, byte_letters, mapped, texts, tokenizer_path

REMEMBER_WORDS, REMEMBER_PAIRS = 300_000, 400_000


class TrieBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = self.letters = {c: b for b, c in enumerate(byte_letters())}
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.ids = {raw(t): i for t, i in vocab.items()}
        self.bytes_of = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for k, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank[vocab[a], vocab[b]] = (k, vocab[a + b])
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pre = Tokenizer.from_file(path).pre_tokenizer
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Plain merges, for a pair of tokens."""
        ids = [self.ids[bytes((b,))] for b in word]
        while len(ids) > 1:
            found = [(self.rank[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in self.rank]
            if not found:
                break
            _, i = min(found)
            ids[i : i + 2] = [self.rank[ids[i], ids[i + 1]][1]]
        return ids

    def apart(self, a: int, b: int) -> bool:
        """Whether the bytes of token a (-1: none) before those of token b encode to a and b."""
        if (got := self.pairs.get((a, b))) is None:
            if len(self.pairs) >= REMEMBER_PAIRS:
                self.pairs.clear()
            want = [b] if a < 0 else [a, b]
            got = self.pairs[a, b] = self.merge(b"".join(self.bytes_of[i] for i in want)) == want
        return got

    def learn(self, words: list[bytes]) -> None:
        """Encodings of distinct words, by one walk of their trie."""
        if len(self.known) + len(words) > REMEMBER_WORDS:
            self.known.clear()
        get, pairs, ids, longest = self.ids.get, self.pairs, self.ids, self.longest
        before, state = b"", [(-1, 0)]  # state[i]: last token of the first i bytes, and where it starts
        for word in sorted(words):
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            del state[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = get(word[start:end])
                    if token is not None:
                        last = state[start][0]
                        ok = pairs.get((last, token))
                        if ok or ok is None and self.apart(last, token):
                            state.append((token, start))
                            break
            out, at = [], len(word)
            while at:
                token, at = state[at]
                out.append(token)
            self.known[word] = tuple(reversed(out))
            before = word

    def words(self, text: str) -> list[bytes | int]:
        """Words of a text as bytes, and special tokens as ids."""
        out: list[bytes | int] = []
        for part in self.split.split(text) if self.split and any(s in text for s in self.special) else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif BEYOND.search(part):
                out += [bytes(map(self.letters.__getitem__, w)) for w, _ in self.pre.pre_tokenize_str(part)]
            else:
                out += map(str.encode, PIECES.findall(part))
        return out

    def encode(self, some: list[str]) -> Iterator[list[int]]:
        cut = [self.words(t) for t in some]
        distinct = {w for c in cut for w in c}
        need = [w for w in distinct if w not in self.known and not isinstance(w, int)]
        if len(self.known) + len(need) > REMEMBER_WORDS:
            self.known.clear()
            need = [w for w in distinct if not isinstance(w, int)]
        if need:
            self.learn(need)
        known = self.known
        for c in cut:
            ids: list[int] = []
            for w in c:
                ids += known[w] if w in known else (w,)
            yield ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[str, TrieBpe] = {}


def codec(path: str | None = None) -> TrieBpe:
    path = path or tokenizer_path()
    if path not in _CODECS:
        _CODECS[path] = TrieBpe(path)
    return _CODECS[path]


SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, decoded string"


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), and the text that the ids decode to."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        import numpy as np

        bpe = codec(path)
        ids = list(bpe.encode(texts(batch.column(1))))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, ids), pa.int64()), pa.array([np.array(i, "<u4").tobytes() for i in ids], pa.binary()), pa.array(map(bpe.decode, ids), pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(mapped(run), SCHEMA)


def op3_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_decode(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
