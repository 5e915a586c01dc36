"""BPE with word ends: exact encoding by a dynamic program over prefixes, and decoding (operator 12).

A vocabulary file of the public tokenizers format gives merges in rank order.
Text is normalised (NFC, lower case per character), cut at the added tokens
and then into words by the file's pattern; each word's UTF-8 bytes are the
symbols, the last one marked as a word end. A word is encoded as follows.

* A *suffix automaton* of all tokens reads the word. Its state after i symbols
  is the longest suffix read that occurs in a token, and the tokens along its
  suffix links are all tokens that end there.
* For every prefix exactly one token can be the last of its encoding: the
  token t, starting at s, whose pair with the stored last token of the prefix
  of length s is *compatible*, i.e. no merge crosses their border while the
  two are built. The test replays the ranks of the two tokens' border spines
  (right children on the left, left children on the right).
* Back-pointers from the end give the ids.

Tokens that the merges themselves never leave standing are found once by the
same test and left out. Work and memory of a word are linear in its length
(times the tokens that end at a place, at most the longest token), whatever
the word. The table of a prefix does not depend on what follows, so the new
words of a batch are taken in sorted order and each goes on from the prefix it
shares with the word before. Words repeat, so each Python worker keeps the ids
of recent words (about ``CACHE`` entries, then it starts anew; results do not
depend on it).

Characters on whose class or lower case Unicode versions differ are left to
the tokenizers library's own normaliser and splitter: the stretches between
blanks that hold a character outside ``KNOWN`` go there, all others are cut
here (``KNOWN`` is tested against the library for every code point).

Defined results: null text = empty text = no ids; repeated rows are kept;
a null id stays null; empty tables give no rows; columns other than the two
named are not read, so clashing names do not matter; very long texts are cut
between a character and a following blank, where no word can cross, and
joined again. The literal text of an added token becomes its id, as in the
library. Ids are little-endian unsigned 32-bit integers; decoding joins the
tokens' spellings by one space, as the library does for a file without a
decoder.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

VOCABULARY = "word_bpe_49k.json"
CHUNK = 1 << 16
CACHE = 300_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: Ranges of characters whose class and lower case are the same here and in the library.
KNOWN = "\x00-\u0557\u2000-\u206f\u3000-\u9fff\uac00-\ud7a3"
_OTHER = re.compile(f"[^{KNOWN}]")
_BLANK = re.compile(r"(?<=[^ \n])(?=[ \n])")
_FINAL = 256  # added to a byte that ends a word


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Path of a vocabulary file of the installed public package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, as letter -> byte.

    Bytes that are printable in Latin-1 stand for themselves, the others take
    the letters from U+0100 on in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


class SuffixAutomaton:
    """Suffix automaton of several strings, with the strings that end along each state's suffix links."""

    def __init__(self, strings: list[tuple[int, list[int]]]):
        self.step: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        for _, s in strings:
            at = 0
            for c in s:
                at = self._extend(at, c)
        own: dict[int, list[tuple[int, int]]] = {}
        for name, s in strings:
            at = 0
            for c in s:
                at = self.step[at][c]
            own.setdefault(at, []).append((len(s), name))
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.step)
        for v in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            mine = tuple(sorted(own.get(v, ()), reverse=True))
            above = self.ends[self.link[v]]
            self.ends[v] = mine + above if mine else above

    def _state(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The part of state ``q`` that holds the strings up to the length of ``p`` plus one."""
        new = self._state(dict(self.step[q]), self.link[q], self.length[p] + 1)
        self.link[q] = new
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, at: int, c: int) -> int:
        q = self.step[at].get(c)
        if q is not None:
            return q if self.length[q] == self.length[at] + 1 else self._split(at, c, q)
        new, p = self._state({}, 0, self.length[at] + 1), at
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new


class PrefixBPE:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        end = model["end_of_word_suffix"]
        self.path = path
        self.spelling = {i: t for t, i in model["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.spelling.update({i: t for t, i in self.added.items()})
        self._added = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        self._word = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        vocab, letters = model["vocab"], byte_letters()

        def symbols(token: str) -> list[int]:
            last = token.endswith(end) and token != end
            bare = [letters[x] for x in (token[:-len(end)] if last else token)]
            return bare[:-1] + [bare[-1] + _FINAL] if last else bare

        #: a token's two parts, its rank (-1: a single symbol) and the token of a pair
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = dict.fromkeys(vocab.values(), -1)
        self.merged: dict[tuple[int, int], int] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            a, b, t = vocab[left], vocab[right], vocab[left + right]
            if t in self.parts or max(self.rank[a], self.rank[b]) >= rank:
                raise ValueError(f"merge {rank} of {path} is not in rank order")
            self.parts[t], self.rank[t], self.merged[a, b] = (a, b), rank, rank
        standing: set[int] = set()
        for t in sorted(self.rank, key=self.rank.__getitem__):
            two = self.parts.get(t)
            if two is None or (two[0] in standing and two[1] in standing and self.first_crossing(*two) == self.rank[t]):
                standing.add(t)
        self.automaton = SuffixAutomaton([(t, symbols(s)) for s, t in vocab.items() if t in standing])
        self._pairs: dict[tuple[int, int], bool] = {}
        self._ids: dict[str, bytes] = {}
        #: the word encoded last with the automaton state, last token and its start of each of its prefixes
        self._table: tuple[list[int], list, list, list] = [], [], [], []
        self._library = None

    def first_crossing(self, left: int, right: int) -> int:
        """Rank of the first merge that joins across the border of two neighbouring tokens; -1 if none does.

        The symbols at the border grow along the two spines. The next event is
        the one of the lowest rank; of equal ranks the one further left:
        growth on the left, then the crossing, then growth on the right.
        """
        spine_l, spine_r = [left], [right]
        while spine_l[-1] in self.parts:
            spine_l.append(self.parts[spine_l[-1]][1])
        while spine_r[-1] in self.parts:
            spine_r.append(self.parts[spine_r[-1]][0])
        never = len(self.merged)
        a, b = spine_l.pop(), spine_r.pop()
        while True:
            cross = self.merged.get((a, b), never)
            grow_l = self.rank[spine_l[-1]] if spine_l else never
            grow_r = self.rank[spine_r[-1]] if spine_r else never
            if cross < grow_l and cross <= grow_r and cross < never:
                return cross
            if not spine_l and not spine_r:
                return -1
            if grow_l <= grow_r:
                a = spine_l.pop()
            else:
                b = spine_r.pop()

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side stay as they are."""
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= 4 * CACHE:
                self._pairs.clear()
            known = self._pairs[left, right] = self.first_crossing(left, right) < 0
        return known

    def encode_symbols(self, word: list[int]) -> list[int]:
        """Ids of a sequence of symbols: the last token of every prefix, then back from the end."""
        step, link, length, ends = self.automaton.step, self.automaton.link, self.automaton.length, self.automaton.ends
        pairs, (before, states, last, start) = self._pairs, self._table
        shared = 0
        for x, y in zip(before, word):
            if x != y:
                break
            shared += 1
        del states[shared:], last[shared:], start[shared:]
        at, held = states[-1] if shared else (0, 0)
        for i in range(shared, len(word)):
            c = word[i]
            go = step[at].get(c)
            while go is None and at:
                at = link[at]
                held = length[at]
                go = step[at].get(c)
            if go is None:
                raise ValueError(f"symbol {c} is not in the vocabulary")
            at = go
            held += 1
            for size, token in ends[at]:
                if size <= held:
                    s = i + 1 - size
                    if not s:
                        break
                    fits = pairs.get((last[s - 1], token))
                    if fits or (fits is None and self.compatible(last[s - 1], token)):
                        break
            else:
                raise ValueError("no token ends here")
            states.append((at, held))
            last.append(token)
            start.append(s)
        self._table = word, states, last, start
        ids, i = [], len(word)
        while i:
            ids.append(last[i - 1])
            i = start[i - 1]
        return ids[::-1]

    def word_ids(self, word: str) -> bytes:
        """Ids of a word of the pattern."""
        raw = list(word.encode())
        raw[-1] += _FINAL
        return np.array(self.encode_symbols(raw), "<u4").tobytes()

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without added tokens."""
        plain = _OTHER.search(text)
        if plain is None:
            return self._word.findall(_normal(text))
        out, lo = [], 0
        while plain is not None:
            p = plain.start()
            a = max(text.rfind(" ", lo, p), text.rfind("\n", lo, p)) + 1 or lo
            ends = [e for e in (text.find(" ", p), text.find("\n", p)) if e >= 0]
            b = min(ends, default=len(text))
            out += self._word.findall(_normal(text[lo:a])) + self._library_words(text[a:b])
            lo, plain = b, _OTHER.search(text, b)
        return out + self._word.findall(_normal(text[lo:]))

    def _library_words(self, text: str) -> list[str]:
        from tokenizers import Tokenizer

        if self._library is None:
            self._library = Tokenizer.from_file(self.path), byte_letters()
        tool, letters = self._library
        cut = tool.pre_tokenizer.pre_tokenize_str(tool.normalizer.normalize_str(text))
        return [bytes(letters[c] for c in w).decode() for w, _ in cut]

    def encode(self, text: str | None, chunk: int = CHUNK) -> bytes:
        """Ids of a whole text as little-endian uint32."""
        return self.encode_all([text], chunk)[0]

    def encode_all(self, texts: list[str | None], chunk: int = CHUNK) -> list[bytes]:
        """Ids of each text as little-endian uint32."""
        cut = [[part for part in self._parts(text or "", chunk)] for text in texts]
        need = {w for parts in cut for words, _ in parts for w in words}
        new = sorted(need.difference(self._ids))
        if len(self._ids) + len(new) > CACHE:
            self._ids.clear()
            new = sorted(need)
        for w in new:
            self._ids[w] = self.word_ids(w)
        self._table = [], [], [], []
        get = self._ids.__getitem__
        return [b"".join([x for words, added in parts for x in (*map(get, words), added)]) for parts in cut]

    def _parts(self, text: str, chunk: int) -> Iterator[tuple[list[str], bytes]]:
        """The words between two added tokens and the id of the one that follows."""
        lo = 0
        for m in chain(self._added.finditer(text), [None]):
            words = [w for piece in pieces(text[lo:m.start() if m else len(text)], chunk) for w in self.words(piece)]
            yield words, np.array([self.added[m.group()]], "<u4").tobytes() if m else b""
            lo = m.end() if m else lo

    def decode(self, ids: bytes) -> str:
        """Spellings of the ids (little-endian uint32), joined by one space."""
        return " ".join(map(self.spelling.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _normal(text: str) -> str:
    """NFC, then the lower case of each character by itself (a capital sigma has no final form)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces(text: str, chunk: int = CHUNK) -> Iterator[str]:
    """``text`` cut between a character and a following blank into pieces of about ``chunk`` code points."""
    lo = 0
    while len(text) - lo > chunk and (m := _BLANK.search(text, lo + chunk)):
        yield text[lo:m.start()]
        lo = m.start()
    yield text[lo:]


@functools.cache
def coder(path: str) -> PrefixBPE:
    """The coder of a vocabulary file, once per process."""
    return PrefixBPE(path)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                     digests: bool = True) -> DataFrame:
    """Encode every text and decode the ids again.

    With ``digests`` the result is ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``; otherwise ``doc_id, n_tokens, ids`` (binary, uint32).
    No shuffle.
    """
    path = path or vocabulary_path()
    schema = RESULT if digests else "doc_id long, n_tokens long, ids binary"

    def run(batches):
        tool = coder(path)
        for b in small_batches(batches, max_bytes=4 << 20):
            ids = tool.encode_all(b.column(1).to_pylist())
            cols = [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if digests:
                cols += [pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                         pa.array([hashlib.sha256(tool.decode(x).encode()).hexdigest() for x in ids], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                cols.append(pa.array(ids, pa.binary()))
                names = ["doc_id", "n_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` (the decoded spellings) from ``doc_id, ids`` of :func:`encode_documents`; null ids give null."""
    path = path or vocabulary_path()

    def run(batches):
        tool = coder(path)
        for b in small_batches(batches):
            text = [None if x.as_py() is None else tool.decode(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
