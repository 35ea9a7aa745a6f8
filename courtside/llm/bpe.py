"""BPE encoding and decoding by forced-boundary splitting.

A merge only ever makes a token of the vocabulary. So two neighbouring bytes that stand next to each other
inside no token are never merged over: between them a cut is certain. Each word is cut at these places, the
fragments are encoded independently, and their ids concatenated. Fragments recur far more often than the
words they stand in; each task keeps a bounded cache of fragments and of white-space separated chunks.

Normalisation is NFC, white space to one space, lower case. Texts of plain characters only (`is_plain`) are
split here; others, and texts with the string of an added token, go by the library's normaliser and splitter, and
then through the same fragments. Decoding looks the ids up in the vocabulary; as the file names no decoder, the
tokens are joined by spaces, as the library does it.

Null texts are empty texts: no ids, empty decoded text. Empty tables give no rows. Rows that repeat an id
are encoded each on their own.
"""

from __future__ import annotations

import functools
import json
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from courtside.llm.plaintext import byte_alphabet, is_plain, parts, tokenizer_file
from courtside.llm.tables import ship, table

CACHED = 100_000
SYMBOLS = 512


class WordCoder:
    """Encodes and decodes with a word-end BPE file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        spec = json.loads(Path(path).read_text())
        model = spec["model"]
        self.whole = Tokenizer.from_file(path)
        self.suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ending = Tokenizer(models.BPE(model["vocab"], merges, end_of_word_suffix=self.suffix))
        self.inner = Tokenizer(models.BPE(model["vocab"], merges))
        self.tokens = {i: t for t, i in model["vocab"].items()} | {a["id"]: a["content"] for a in spec["added_tokens"]}
        self.added = regex.compile("|".join(regex.escape(a["content"]) for a in spec["added_tokens"]) or r"(?!)")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.alphabet = str.maketrans({chr(b): c for b, c in byte_alphabet().items()})
        self.joined = self._joined(model["vocab"])
        self.chunks: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.fragments: tuple[dict, dict] = ({}, {})

    def forget(self) -> None:
        """Empties the caches."""
        self.chunks, self.older, self.fragments = {}, {}, ({}, {})

    def _joined(self, vocab: dict[str, int]) -> np.ndarray:
        """Which pairs of symbols stand next to each other inside a token."""
        found = np.zeros(SYMBOLS * SYMBOLS, bool)
        for token in vocab:
            code = np.fromiter(map(ord, token.removesuffix(self.suffix) if self.suffix else token), np.int64)
            found[code[:-1] * SYMBOLS + code[1:]] = True
        return found

    def cut(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The fragments of words of byte symbols, which of them end a word, and how many each word has."""
        run = "".join(words)
        if not run:
            return [], np.zeros(0, bool), np.zeros(len(words), np.int64)
        code = np.frombuffer(run.encode("utf-16-le"), np.uint16).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        certain = np.empty(len(code), bool)
        certain[:-1] = ~self.joined[code[:-1] * SYMBOLS + code[1:]]
        certain[ends - 1] = True
        at = np.flatnonzero(certain) + 1
        last = np.searchsorted(at, ends)
        final = np.zeros(len(at), bool)
        final[last] = True
        bounds = at.tolist()
        return [run[a:b] for a, b in zip([0, *bounds], bounds, strict=False)], final, np.diff(last + 1, prepend=0)

    def word_ids(self, words: list[str]) -> list[tuple[str, str]]:
        """Per word of byte symbols its ids as text and its decoded text; new fragments are encoded in one call."""
        cuts, final, counts = self.cut(words)
        flags = final.tolist()
        for known in self.fragments:
            if len(known) > CACHED:
                known.clear()
        for end, coder in ((False, self.inner), (True, self.ending)):
            known = self.fragments[end]
            new = list({f for f, e in zip(cuts, flags, strict=True) if e == end} - known.keys())
            for fragment, code in zip(new, coder.encode_batch_fast(new, add_special_tokens=False), strict=True):
                known[fragment] = (" ".join(map(str, code.ids)), self.decode(code.ids))
        inner, ending = self.fragments
        found = [ending[f] if e else inner[f] for f, e in zip(cuts, flags, strict=True)]
        out, at = [], 0
        for n in counts.tolist():
            own = found[at : at + n]
            out.append(own[0] if n == 1 else (" ".join([x for x, _ in own]), " ".join([y for _, y in own])))
            at += n
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))

    def _symbols(self, word: str) -> str:
        return word if word.isascii() else word.encode("utf-8").decode("latin-1").translate(self.alphabet)

    def _learn(self, chunks: list[str]) -> None:
        """Adds the ids, as text, and the decoded text of plain lower-case chunks to the cache."""
        words = [self.words.findall(c) for c in chunks]
        found, at = self.word_ids([self._symbols(w) for own in words for w in own]), 0
        for chunk, own in zip(chunks, words, strict=True):
            here = found[at : at + len(own)]
            at += len(own)
            self.chunks[chunk] = here[0] if len(here) == 1 else (" ".join([x for x, _ in here]), " ".join([y for _, y in here]))

    def _other(self, text: str) -> tuple[str, str]:
        """Any text: added tokens are found first, the rest goes by the library's normaliser and splitter."""
        out, at = [], 0
        for m in [*self.added.finditer(text), None]:
            if part := text[at : m.start() if m else len(text)]:
                pieces = self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(part))
                out += self.word_ids([p for p, _ in pieces])
            if m:
                out.append((str(self.whole.token_to_id(m[0])), m[0]))
                at = m.end()
        return " ".join([x for x, _ in out]), " ".join([y for _, y in out])

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Per text its ids in decimal, joined by a space, and the decoded text."""
        split = [
            t.lower().split() if is_plain(t) and not ("<" in t and self.added.search(t)) else None for t in texts
        ]
        if len(self.chunks) > CACHED:
            self.older, self.chunks = self.chunks, {}
        new = set().union(*filter(None, split)) - self.chunks.keys()
        for chunk in new & self.older.keys():
            self.chunks[chunk] = self.older[chunk]
        if new := new - self.chunks.keys():
            self._learn(list(new))
        for text, own in zip(texts, split, strict=True):
            if own is None:
                yield self._other(text)
            else:
                found = list(map(self.chunks.__getitem__, own))
                yield " ".join([x for x, _ in found]), " ".join([y for _, y in found])


@functools.lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    """The coder of a file, made once in a Python worker."""
    return WordCoder(path)


def encoded(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    place_col: str | None = None,
    batch_chars: int = 2_000_000,
) -> DataFrame:
    """Per row: doc_id, ids (decimal, joined by a space), n_tokens, decoded, and place (long) where a column of it is named.

    The file must be there on every executor.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *([F.col(place_col).cast("long").alias("place")] if place_col else []),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = coder(tokenizer)
        use.forget()  # a worker lives on between tasks and stages
        for batch in batches:
            for part, texts in parts(batch, batch_chars):
                found = list(use.encode_texts(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([x for x, _ in found], pa.string()),
                        pa.array([x.count(" ") + 1 if x else 0 for x, _ in found], pa.int64()),
                        pa.array([x for _, x in found], pa.string()),
                        *part.columns[2:],
                    ],
                    names=["doc_id", "ids", "n_tokens", "decoded", *part.schema.names[2:]],
                )
        use.forget()

    kinds = "doc_id long, ids string, n_tokens long, decoded string"
    return rows.mapInArrow(encode, kinds + ", place long" if place_col else kinds)


def token_digests(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded(docs, tokenizer, id_col=id_col, text_col=text_col).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op3_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
