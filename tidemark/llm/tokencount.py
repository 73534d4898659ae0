"""Token counts: a prefix dynamic program holds the exact number of tokens of every prefix.

Within a piece of text that the tokenizer's pattern keeps together, byte-pair encoding has this property: of the tokens
that end at byte i, exactly one can follow the last token of the encoding of what comes before it, namely the one for which
no merge would have crossed the boundary.  So count[i] = count[i - len(t)] + 1 and last[i] = t: one pass gives the counts
of all prefixes of the piece, and sums over pieces give those of the text.

The table of a text holds the count at every prefix, as steps from one character to the next (two bits each; the rare steps
other than 0, 1 and -1 follow), and ``Prefixes`` answers budget and truncation questions from it alone: neither the text nor
the tokenizer is needed again.  Where a prefix is split otherwise than the text, its count is mended when the table is made:
at the end of a run of blanks (alone it is one piece, before a word its last blank belongs to the word), inside unfinished
contractions, and inside special strings.

Defined cases: a null or empty text has 0 bytes and 0 tokens; the special strings of the tokenizer inside texts (none of which
contains another) count as one token each, the library's default; repeated rows each give a row; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, worker_cache

_SPACE = " \t-\r"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Texts of these characters only do without the general classes of characters.
_PLAIN = re.compile("[^\t-\r -~À-ÿ]")
_RUNS = re.compile(f"[{_SPACE}]{{2,}}(?=[^{_SPACE}])")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^{_SPACE}{_LETTER}0-9]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")

#: Contractions of two letters: 'r, 'v and 'l alone are two pieces.
_LONG_CONTRACTIONS = {"'re", "'ve", "'ll"}


def _bytes_of_marks() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Counter:
    """Exact prefix counts for a byte-level BPE in a tokenizer file."""

    def __init__(self, path: str, most: int = 1_000_000):
        import json

        import regex

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        marks = _bytes_of_marks()
        raw = lambda word: bytes(marks[c] for c in word)
        special = {x["content"] for x in told["added_tokens"]}
        self.ids = {raw(w): i for w, i in told["model"]["vocab"].items() if w not in special}
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, pair in enumerate(told["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b = raw(a), raw(b)
            whole, a, b = self.ids[a + b], self.ids[a], self.ids[b]
            self.rank[a, b] = r
            self.parts.setdefault(whole, (r, a, b))
        self.general = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
        self.spine_right: dict[int, list[tuple[int, float]]] = {}
        self.spine_left: dict[int, list[tuple[int, float]]] = {}
        self.fits: dict[int, bool] = {}
        self.general_runs = regex.compile(r"\p{White_Space}{2,}(?=\P{White_Space})")
        self.known: dict[str, bytes] = {}
        self.most = most
        # a token that merges can't build never stands in an encoding
        for word, i in list(self.ids.items()):
            if i in self.parts and not self._follows(*self.parts[i][1:], self.parts[i][0]):
                del self.ids[word]
        self.longest = max(map(len, self.ids))

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The pieces that stand at the token's edge while it is built, each with the rank of the merge that takes it up."""
        kept = self.spine_left if side == 1 else self.spine_right
        found = kept.get(token)
        if found is None:
            found, until, edge = [], float("inf"), token
            while True:
                found.append((edge, until))
                if edge not in self.parts:
                    break
                until, edge = self.parts[edge][0], self.parts[edge][side]
            kept[token] = found
        return found

    def _follows(self, left: int, right: int, below: float = float("inf")) -> bool:
        """Whether no merge (of a rank under ``below``) crosses the boundary when ``right`` follows ``left``."""
        for x, x_until in self._spine(left, 2):
            for y, y_until in self._spine(right, 1):
                r = self.rank.get((x, y))
                if r is not None and r < x_until and r <= y_until and r < below:
                    return False
        return True

    def prefixes(self, piece: bytes) -> list[int]:
        """The number of tokens of every prefix, from the empty one to the whole of ``piece``."""
        count, last = [0], [-1]
        ids, fits, longest = self.ids, self.fits, self.longest
        for i in range(1, len(piece) + 1):
            for j in range(max(0, i - longest), i):
                t = ids.get(piece[j:i])
                if t is None:
                    continue
                if j:
                    key = last[j] << 20 | t
                    ok = fits.get(key)
                    if ok is None:
                        if len(fits) > 2_000_000:
                            fits.clear()
                        ok = fits[key] = self._follows(last[j], t)
                    if not ok:
                        continue
                count.append(count[j] + 1)
                last.append(t)
                break
            else:
                raise ValueError(f"no token ends at byte {i}")
        return count

    def steps(self, piece: str) -> bytes:
        """From each of the piece's prefixes to the one longer by a character: how many tokens more, 16 bits each."""
        found = self.known.get(piece)
        if found is None:
            raw = piece.encode()
            counts = self.prefixes(raw)
            if len(raw) != len(piece):
                counts = [c for c, b in zip(counts, [*raw, 0], strict=True) if b & 0xC0 != 0x80]
            if piece in _LONG_CONTRACTIONS:  # without its last letter none of them is a piece
                counts[2] = 1 + self.prefixes(raw[1:2])[-1]
            found = np.diff(counts).astype("<i2").tobytes()
            if len(self.known) >= self.most:
                self.known.clear()
            if len(piece) <= 64:
                self.known[piece] = found
        return found

    def count(self, piece: str) -> int:
        return int(np.frombuffer(self.steps(piece), "<i2").sum())

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """The steps of each text, special strings taken as any others."""
        simple = [not _PLAIN.search(t) for t in texts]
        pieces: list[str] = []
        for text, plain in zip(texts, simple, strict=True):
            pieces += _PIECES.findall(text) if plain else self.general.findall(text)
        try:
            raw = b"".join(map(self.known.__getitem__, pieces))
        except KeyError:
            raw = b"".join(map(self.steps, pieces))
        flat, at, out = np.frombuffer(raw, "<i2").astype(np.int32), 0, []
        for text, plain in zip(texts, simple, strict=True):
            own = flat[at : at + len(text)]
            for m in (_RUNS if plain else self.general_runs).finditer(text):
                run = m[0]
                more = self.count(run) - self.count(run[:-1]) - self.count(run[-1])
                own[m.end() - 1] += more
                own[m.end()] -= more
            out.append(own)
            at += len(text)
        return out

    def tables(self, texts: list[str | None]) -> list[np.ndarray]:
        """The steps of each text, one for each character; all counts follow by summing up."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        marked = [bool(t and self.special and self.special.search(t)) for t in texts]
        plain = [i for i, t in enumerate(texts) if t and not marked[i]]
        for i, own in zip(plain, self._plain([texts[i] for i in plain]), strict=True):
            out[i] = own
        for i in np.flatnonzero(marked).tolist():
            out[i] = self._with_special(texts[i])
        return out

    def _with_special(self, text: str) -> np.ndarray:
        steps, at = [], 0
        for m in self.special.finditer(text):
            # inside the special string a prefix holds but its beginning, as any other characters
            (before, unfinished) = self._plain([text[at : m.start()], text[at : m.end() - 1]])
            upto = np.concatenate([np.cumsum(before), np.cumsum(unfinished)[len(before) :], [before.sum() + 1]])
            steps.append(np.diff(upto, prepend=0))
            at = m.end()
        return np.concatenate([*steps, *self._plain([text[at:]])]).astype(np.int32)


def packed(steps: np.ndarray) -> bytes:
    """Number of steps (32 bits), two bits for each (0, 1, 3: -1, 2: another one), then the other ones (16 bits each)."""
    common = (steps >= -1) & (steps <= 1)
    code = np.where(common, steps & 3, 2).astype(np.uint8)
    code = np.concatenate([code, np.zeros(-len(code) % 4, np.uint8)]).reshape(-1, 4)
    return len(steps).to_bytes(4, "little") + (code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6).tobytes() + steps[~common].astype("<i2").tobytes()


def unpacked(table: bytes) -> np.ndarray:
    n = int.from_bytes(table[:4], "little")
    four = np.frombuffer(table, np.uint8, -(-n // 4), 4)
    code = ((four[:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).ravel()[:n]
    steps = np.array([0, 1, 0, -1], np.int32)[code]
    steps[code == 2] = np.frombuffer(table, "<i2", offset=4 + len(four))
    return steps


class Prefixes:
    """Answers for one text from its table: ``at(i)`` tokens in the first i characters; ``cut(budget)`` the length of the longest
    prefix of at most ``budget`` tokens."""

    def __init__(self, table: bytes):
        self.counts = np.concatenate([[0], np.cumsum(unpacked(table))])

    def at(self, i: int) -> int:
        return int(self.counts[min(i, len(self.counts) - 1)])

    def cut(self, budget: int) -> int:
        return int(np.flatnonzero(self.counts <= budget)[-1])


def fitting(table: Column, budget: int) -> Column:
    """The number of characters of the longest prefix within ``budget`` tokens, from a text's table."""

    @F.pandas_udf("long")
    def cut(tables: pd.Series) -> pd.Series:
        return pd.Series([Prefixes(t).cut(budget) for t in tables], dtype="int64")

    return cut(table)


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and prefix_table (see ``Prefixes``) of every row of ``docs`` (doc_id, text).

    ``tokenizer`` is the path of a byte-level BPE in a tokenizer file.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cache(f"counts of {tokenizer}", lambda: Counter(tokenizer))
        for part in slices(batches, 1):
            steps = counter.tables(part.column(1).to_pylist())
            totals = [int(x.sum()) for x in steps]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(totals, pa.int64()), pa.array(list(map(packed, steps)), pa.binary())], names=["doc_id", "n_bytes", "n_tokens", "prefix_table"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return given.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, prefix_table binary")
