"""Byte-pair encoding by one depth-first walk over a trie of distinct words.

A prefix of a word has one BPE encoding, and that encoding is the encoding of
a shorter prefix plus one last token. So the last token is all the state a
prefix needs: the distinct words of a batch go into a trie, the walk gives
every node its last token from the states on its own path, and a word's ids
are read off backwards. Words that share a prefix share its states.

A token may follow a token when no merge across their boundary could have
happened first. Both are looked at as they grow: the left one's pieces that
touch the boundary (each with the rank that forms it and the rank that uses it
up) against the right one's. A merge of two touching pieces that comes before
both are used up would have won, so the two tokens are not neighbours.

The file is a tokenizers JSON of the kind "BPE with word ends" (byte-level
alphabet, lower case, white space dropped). Texts are cut into words by its
own rule; special tokens' strings in a text are special tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gatewise.llm.common import id_and_text, slices

#: Characters of words whose ids a worker keeps; past it, those not met lately go.
KEPT_CHARS = 5_000_000
#: Pairs of tokens whose boundary test a worker keeps, and the words of one trie.
KEPT_PAIRS, TRIE_WORDS = 250_000, 4096
#: Characters below this one are composed already and fold case one by one.
SIMPLE = regex.compile("[^\x00-˿]")
#: Bytes of results sent back in one batch.
OUT_BYTES = 8 << 20


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest
    follow from U+0100 on in byte order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Node:
    """What a prefix of a token spells: the next letters, its longest own suffix
    in the trie, and the tokens that end it."""

    __slots__ = ("next", "back", "inner", "final")

    def __init__(self) -> None:
        self.next: dict[str, Node] = {}
        self.back: Node | None = None
        self.inner: tuple[int, ...] = ()
        self.final: tuple[int, ...] = ()


class Merges:
    """Tokens by their text, with what the boundary test needs of each."""

    def __init__(self, vocab: dict[str, int], merges: list, end: str):
        self.vocab, self.end = vocab, end
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[left, right] = rank
            if left + right in self.parts:
                raise ValueError(f"two merges make {left + right!r}")
            self.parts[left + right] = (left, right)
        self._edges: dict[tuple[str, int], list[tuple[str, int, float]]] = {}
        self._whole: dict[str, bool] = {}
        # left id * size + right id -> may right follow left, for all pairs met so far
        self._follows: dict[int, bool] = {}
        self.size = max(vocab.values(), default=0) + 1
        self.names: list[str] = [""] * self.size
        self.lengths = [0] * self.size  # letters, without the word end
        self.root = self.suffixes()

    def suffixes(self) -> Node:
        """Trie of all tokens' letters, where every node knows the tokens that
        end what it spells, the longest first, inside words and at their ends."""
        root = Node()
        for token, i in self.vocab.items():
            if not self.whole(token):
                continue
            ends = token.endswith(self.end)
            letters = token[:-len(self.end)] if ends else token
            self.names[i], self.lengths[i] = token, len(letters)
            node = root
            for letter in letters:
                if letter not in node.next:
                    node.next[letter] = Node()
                node = node.next[letter]
            if ends:
                node.final = (i,)
            else:
                node.inner = (i,)
        level = [(root, letter, node) for letter, node in root.next.items()]
        while level:  # shorter texts first: a suffix's tokens are known before they are asked for
            for parent, letter, node in level:
                back = parent.back
                while back is not None and letter not in back.next:
                    back = back.back
                node.back = root if back is None else back.next[letter]
                node.inner = node.inner + node.back.inner if node.inner else node.back.inner
                node.final = node.final + node.back.final if node.final else node.back.final
            level = [(node, letter, child) for _, _, node in level for letter, child in node.next.items()]
        return root

    def formed(self, token: str) -> int:
        return self.rank[self.parts[token]] if token in self.parts else -1

    def edge(self, token: str, side: int) -> list[tuple[str, int, float]]:
        """Pieces of a token at one side: (piece, rank that forms it, rank that uses it up)."""
        key = (token, side)
        if key not in self._edges:
            out, used = [], float("inf")
            piece = token
            while True:
                made = self.formed(piece)
                out.append((piece, made, used))
                if piece not in self.parts:
                    break
                piece, used = self.parts[piece][side], made
            self._edges[key] = out
        return self._edges[key]

    def apart(self, left: str, right: str, joined: bool = False) -> bool:
        """No merge crosses the boundary of ``left`` and ``right``; with
        ``joined``, none but the merge of the two whole tokens."""
        for x, made_x, used_x in self.edge(left, 1):
            for y, made_y, used_y in self.edge(right, 0):
                rank = self.rank.get((x, y))
                if rank is None or (joined and x == left and y == right):
                    continue
                when = max(rank, made_x, made_y)
                if when < used_x and when <= used_y:  # of equal merges, the left one goes first
                    return False
        return True

    def whole(self, token: str) -> bool:
        """Encoding the token's own text gives the token."""
        found = self._whole.get(token)
        if found is None:
            found = True
            if token in self.parts:
                left, right = self.parts[token]
                found = self.whole(left) and self.whole(right) and self.apart(left, right, joined=True)
            self._whole[token] = found
        return found

    def last(self, states: list[int], depth: int, fits: tuple[int, ...]) -> int:
        """Last token of the prefix of ``depth`` letters: of the tokens that end
        it (``fits``), the longest that may follow the last token before it."""
        lengths, size, known = self.lengths, self.size, self._follows
        for token in fits:
            at = depth - lengths[token]
            if not at:
                return token
            pair = states[at] * size + token
            good = known.get(pair)
            if good is None:
                if len(known) >= KEPT_PAIRS:
                    known.clear()
                    self._edges.clear()
                good = known[pair] = self.apart(self.names[states[at]], self.names[token])
            if good:
                return token
        raise ValueError(f"no token ends a prefix of {depth} letters: the vocabulary lacks a letter")

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each word (in byte letters): neighbours in alphabetical order,
        which share their prefixes, go into one trie of at most TRIE_WORDS words."""
        order = sorted(words)
        out: dict[str, list[int]] = {}
        for at in range(0, len(order), TRIE_WORDS):
            out |= self.walk(order[at:at + TRIE_WORDS])
        return out

    def walk(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of each word, by one depth-first walk over their trie."""
        trie: dict = {}
        for word in words:
            node = trie
            for letter in word:
                if letter in node:
                    node = node[letter]
                else:
                    node[letter] = node = {}
            node[""] = word
        out: dict[str, list[int]] = {}
        lengths, root = self.lengths, self.root
        states = [0]  # the last token of each prefix on the path
        stack = [(trie, 0, root)]
        while stack:
            node, depth, spelled = stack.pop()
            if depth:
                del states[depth:]
                if len(node) > ("" in node):  # no word's state is asked for past its end
                    states.append(self.last(states, depth, spelled.inner))
            for letter, child in node.items():
                if letter:
                    # the longest end of the prefix that some token starts with
                    at = spelled
                    while letter not in at.next and at.back is not None:
                        at = at.back
                    stack.append((child, depth + 1, at.next.get(letter, root)))
                elif depth:
                    token = self.last(states, depth, spelled.final)
                    ids, at = [token], depth - lengths[token]
                    while at:
                        token = states[at]
                        ids.append(token)
                        at -= lengths[token]
                    ids.reverse()
                    out[child] = ids
        return out


class WordBpe:
    """Encoder and decoder of one tokenizers JSON file with word ends."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*model["vocab"].items(), *self.special.items()]}
        # the file's own rules for case, composition and cutting
        self.rules = Tokenizer.from_file(path)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word = regex.compile(split)
        self.marks = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)))
        letters = byte_letters()
        self.letters = [letters[b] for b in range(256)]
        self.table = {b: letters[b] for b in range(256)}
        # words met lately, and those met before them
        self.kept: dict[str | int, bytes] = {}
        self.older: dict[str | int, bytes] = {}
        self.room = KEPT_CHARS // 2

    def in_letters(self, word: str) -> str:
        return word.encode("utf-8").decode("latin-1").translate(self.table)

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens, as plain text or, where the
        file's own rules are needed, marked by a leading tab in byte letters."""
        if SIMPLE.search(text) is None:
            return self.word.findall(text.lower())
        normal = self.rules.normalizer.normalize_str(text)
        return ["\t" + w for w, _ in self.rules.pre_tokenizer.pre_tokenize_str(normal)]

    def pieces(self, text: str) -> list:
        """Words and special ids (ints) of a text in order."""
        if "<|" not in text or self.marks.search(text) is None:
            return self.words(text)
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += self.words(text[at:m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self.words(text[at:])

    def learn(self, texts: list[list]) -> None:
        """Encode the words that the worker has not met (or no longer keeps)."""
        met = set().union(*texts)
        new = met.difference(self.kept)
        chars = sum(len(w) for w in new if isinstance(w, str))
        if chars > self.room:
            self.older, self.kept, new = self.kept, {}, met
            chars = sum(len(w) for w in met if isinstance(w, str))
            self.room = KEPT_CHARS // 2
        self.room -= chars
        known = new.intersection(self.older)
        for w in known:
            self.kept[w] = self.older.pop(w)
        new -= known
        spelled = {}
        for w in new:
            if isinstance(w, int):
                self.kept[w] = pack("<I", w)
            else:
                spelled[w] = w[1:] if w[0] == "\t" else self.in_letters(w)
        ids = {letters: pack(f"<{len(got)}I", *got)
               for letters, got in self.merges.encode_words(set(spelled.values())).items()}
        for w, letters in spelled.items():
            self.kept[w] = ids[letters]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.pieces(t) for t in texts]
        self.learn(cut)
        kept = self.kept
        return [b"".join([kept[w] for w in pieces]) for pieces in cut]

    def decode(self, ids: bytes) -> str:
        """Text of packed ids: the tokens' own strings, joined by spaces."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit integers), decoded.

    ``path`` names the tokenizer file on every executor. One pass without a
    shuffle; each worker keeps the encodings of the words it met, up to a
    fixed number of characters. Null and empty texts give no ids and an empty
    string; texts of any length are encoded whole.
    """
    rows = id_and_text(docs, id_col, text_col)
    schema = rows.schema[0:1].add("ids", "binary").add("decoded", "string")
    kind = pa.binary(), pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            for part in slices(batch, 128):
                got = [(ids, bpe.decode(ids)) for ids in bpe.encode(part.column(1).to_pylist())]
                at = size = 0
                for i, (ids, decoded) in enumerate(got, 1):
                    size += len(ids) + len(decoded)
                    if size >= OUT_BYTES or i == len(got):
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).slice(at, i - at), pa.array([a for a, _ in got[at:i]], kind[0]),
                             pa.array([b for _, b in got[at:i]], kind[1])], names=["doc_id", "ids", "decoded"])
                        at, size = i, 0

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, decoded of packed ``ids`` (null ids: the empty string)."""
    rows = encoded.select("doc_id", "ids")
    schema = rows.schema[0:1].add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            for part in slices(batch, 64):
                texts = [bpe.decode(x or b"") for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())],
                                                 names=["doc_id", "decoded"])

    return rows.mapInArrow(run, schema)
