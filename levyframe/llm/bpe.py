"""BPE encoding and decoding with a trie of distinct words.

A batch's distinct words go into a trie, spelled in the tokenizer's start
symbols (a byte, or a byte that ends a word).  A depth-first walk gives every
node the last token of its path's encoding; that token, and the state of the
node where it began, say all about the path.  So what words share at their
start is encoded once.

The last token of a path is its one suffix among the vocabulary's tokens that
the merges can leave standing next to the last token of the path before it.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.llm.common import drop_columns, packed, quoted, read, result_schema, unpacked

#: How the tokenizer splits normalized text (as its file says, checked when it is read).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of a generation whose encodings a Python worker remembers, and pairs of tokens.
WORDS_KEPT, PAIRS_KEPT = 300_000, 500_000


def byte_characters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use, by the usual rule: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordBPE:
    """A byte-level BPE with word ends, read from a tokenizers file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if split["pattern"]["Regex"] != PIECES or kinds != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != "</w>" or spec["decoder"] is not None:
            raise ValueError(f"{path} is another kind of tokenizer")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*model["vocab"].items(), *self.special.items()]}
        byte = byte_characters()

        def spell(token: str) -> str:
            end = token.endswith("</w>") and len(token) > 4
            symbols = [chr(byte[c]) for c in (token[:-4] if end else token)]
            if end:
                symbols[-1] = chr(ord(symbols[-1]) + 256)
            return "".join(symbols)

        self.spelling = {i: spell(t) for t, i in model["vocab"].items()}
        self.tokens = {s: i for i, s in self.spelling.items()}
        ids = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.tokens))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[int, str, str]] = {}
        self.old: dict[str, tuple[int, str, str]] = {}
        self.pieces = regex.compile(PIECES)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def merged(self, symbols: str) -> list[int]:
        """Plain BPE: the first pair of lowest rank is merged, again and again."""
        out = [self.tokens[s] for s in symbols]
        while len(out) > 1:
            rank, at = min((self.merges.get((a, b), (1 << 60, 0))[0], i) for i, (a, b) in enumerate(zip(out, out[1:], strict=False)))
            if rank == 1 << 60:
                break
            out[at : at + 2] = [self.merges[out[at], out[at + 1]][1]]
        return out

    def stands(self, before: int, token: int) -> bool:
        """Whether the merges leave these two tokens as they are, side by side; before is -1 at the start."""
        key = (before, token)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            if before < 0:
                known = self.merged(self.spelling[token]) == [token]
            else:
                known = self.merged(self.spelling[before] + self.spelling[token]) == [before, token]
            self.pairs[key] = known
        return known

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, its tokens) for distinct non-empty words."""
        root: dict = {}
        for word in words:
            raw = word.encode()
            node = root
            for b in raw[:-1]:
                node = node.setdefault(chr(b), {})
            node[chr(raw[-1] + 256)] = word
        tokens, spelling, stands, longest, known = self.tokens.get, self.spelling, self.stands, self.longest, self.pairs.get
        last = [-1]  # by depth, of the path to the node at hand
        todo = [(root, 0, "")] if root else []
        while todo:
            node, depth, tail = todo.pop()  # tail: the end of the path, as long as the longest token
            del last[max(depth, 1) :]
            while True:
                if depth == len(last):
                    for k in range(len(tail)):
                        token = tokens(tail[k:])
                        if token is not None:
                            before = last[k - len(tail)]
                            fits = known((before, token))
                            if stands(before, token) if fits is None else fits:
                                last.append(token)
                                break
                if node.__class__ is str:
                    out, at = [], depth
                    while at:
                        token = last[at]
                        out.append(token)
                        at -= len(spelling[token])
                    yield node, out[::-1]
                    break
                # on along one child, the others wait
                children = iter(node.items())
                symbol, child = next(children)
                if len(node) > 1:
                    todo.extend([(c, depth + 1, (tail + s)[-longest:]) for s, c in children])
                node, depth, tail = child, depth + 1, (tail + symbol)[-longest:]

    def split(self, text: str) -> Iterator[str | int]:
        """Words and ids of special tokens, in order."""
        parts = self.specials.split(text) if "<|" in text else [text]
        for part in parts:
            if part in self.special:
                yield self.special[part]
            else:
                if not part.isascii():
                    # character by character, so a sigma at a word's end is no special case
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                yield from self.pieces.findall(part.lower())

    def prepare(self, texts: list[list[str | int]]) -> None:
        """Encode what these texts have of words that aren't known yet.

        Words live in two generations: when the young one is full it becomes the old one, from which words in use come back.
        """
        here = {w for words in texts for w in words if w.__class__ is str}
        if len(self.words) + len(here) > WORDS_KEPT:
            self.old, self.words = self.words, {}
        new = here - self.words.keys()
        again = new & self.old.keys()
        for word in again:
            self.words[word] = self.old[word]
        for word, ids in self.encode_words(new - again):
            self.words[word] = (len(ids), " ".join(map(str, ids)), self.decode(ids))

    def decode(self, ids: Iterable[int]) -> str:
        """As the library does where a tokenizer has no decoder: the tokens' names, joined by spaces."""
        return " ".join([self.names[i] for i in ids])

    def encode(self, text: str) -> list[int]:
        words = list(self.split(text))
        self.prepare([words])
        return [int(i) for w in words for i in ([w] if isinstance(w, int) else self.words[w][1].split())]


_loaded: dict[str, WordBPE] = {}


def load(path: str) -> WordBPE:
    """Once a Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


#: Characters of text that are encoded together.
TOGETHER = 1_000_000


def _digests(bpe: WordBPE, texts: list[str]) -> Iterator[tuple[int, str, str]]:
    split = [list(bpe.split(t)) for t in texts]
    bpe.prepare(split)
    known = bpe.words
    for words in split:
        parts = [known[w] if w.__class__ is str else (1, str(w), bpe.names[w]) for w in words]
        ids = " ".join([p[1] for p in parts])
        text = " ".join([p[2] for p in parts])
        yield sum([p[0] for p in parts]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def _ids(bpe: WordBPE, texts: list[str]) -> Iterator[tuple[list[int], str]]:
    split = [list(bpe.split(t)) for t in texts]
    bpe.prepare(split)
    for words in split:
        ids = [int(i) for w in words for i in ([w] if isinstance(w, int) else bpe.words[w][1].split())]
        yield ids, bpe.decode(ids)


def _together(column: pa.Array) -> Iterator[list[str]]:
    group, size = [], 0
    for value in column:
        group.append(value.as_py() or "")
        size += len(group[-1])
        if size >= TOGETHER:
            yield group
            group, size = [], 0
    if group:
        yield group


def _map_texts(docs: DataFrame, text_col: str, path: str, each, results: dict[str, tuple[str, pa.DataType]]) -> DataFrame:
    """docs with the text column replaced by the results; columns of docs with the results' names go."""
    docs = drop_columns(docs, list(results))
    rows = packed(docs, [text_col], text=F.col(quoted(text_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            done = [x for group in _together(batch.column(batch.num_columns - 1)) for x in each(bpe, group)]
            columns = zip(*done, strict=True) if done else [()] * len(results)
            made = [pa.array(list(c), kind) for c, (_, kind) in zip(columns, results.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=[*batch.schema.names[:-1], *results])

    out = rows.mapInArrow(run, result_schema([rows.schema["rest"]], ", ".join(f"{name} {kind}" for name, (kind, _) in results.items())))
    return out.select(*unpacked(out, [c for c in docs.columns if c != text_col]), *results)


def encode_documents(docs: DataFrame, path: str, *, text_col: str = "text") -> DataFrame:
    """docs with the text replaced by ids (array of int) and decoded (string).

    Null texts count as empty and give no ids.  Texts of any length are encoded
    whole; repeated rows and other columns pass unchanged; columns of docs
    named like the results are replaced.  An empty table gives an empty result.
    """
    return _map_texts(docs, text_col, path, _ids, {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string())})


def encoding_digests(docs: DataFrame, path: str, *, text_col: str = "text") -> DataFrame:
    """docs with the text replaced by n_tokens, ids_sha256 and decoded_sha256; otherwise as encode_documents, without moving the ids."""
    return _map_texts(docs, text_col, path, _digests, {"n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())})


def public_tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encoding_digests(docs, public_tokenizer("word_bpe_49k.json"))


QUERIES = {"op4_bpe": op4_bpe}
SQL: dict[str, str] = {}
