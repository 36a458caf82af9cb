"""Token counts of a byte-level pair-merging tokenizer, by compiling it to finite-state transducers.

Method
    Two deterministic transducers replace the tokenizer.

    The *cutter* cuts texts into pieces as the tokenizer's pattern does (contractions, letters, digits, other signs, white
    space). Its symbols are classes of characters with what the pattern looks ahead for folded in, so eight states are
    enough. A slice of text is dealt into chunks; the map of a chunk from every state at its start to the state at its end
    needs no neighbour, the maps are composed by a parallel prefix scan, and then every chunk knows its first state and
    marks its cuts. All chunks of a slice move together, symbol by symbol.

    The *counter* reads the bytes of a piece. Any prefix of a piece has one encoding, and it is the encoding of a shorter
    prefix with one token added. So the state is the set of places where the next token may have begun: the node of the
    vocabulary's trie reached since, the token before, and how many tokens lie before it beyond those that every entry
    has. Two tokens may stand side by side if no merge across their border comes before the merges inside them. An arc is
    annotated with the tokens that it emits: those that no continuation can change any more. A state is annotated
    with those that are left at the end of a piece. Arcs are compiled from the vocabulary when first used and kept by the worker;
    past ``STATES`` of them the table starts anew, which changes time and not counts.

Plan: one narrow pass, no shuffle. The compiled vocabulary is broadcast; its size is the tokenizer's and does not grow with
    the data. A task holds a slice of about a megabyte of text, or one longer text.

Defined results
    Null and empty texts have no bytes and no tokens. Rows are judged one by one, so repeated rows and ids don't matter. The
    tokenizer's added tokens count one wherever their string stands in a text. Columns of the result named like those of the
    input replace them. A tokenizer of another kind than the method covers is refused when it is compiled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.words import slices

RESULT = "token_bytes long, token_count long"

CHUNK = 128
STATES = 1 << 18
PIECES = 1 << 18  # counts of pieces that a worker remembers
LONG = 64  # bytes; longer pieces are not remembered

LETTER, DIGIT, SIGN, SPACE, BLANK = range(5)
_POINTS = 0x110000

# What the tokenizer's pattern takes as contractions after an apostrophe.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

# -- the cutter ------------------------------------------------------------------------------------------------

# States: what the piece that is open may go on with.  NOTHING also is the start.
NOTHING, LETTERS, DIGITS, SIGNS, PREFIX, BLANKS, ONE_LEFT, TWO_LEFT = range(8)
# Symbols.  Blanks (white space) before another blank or the end of the text, and the last ones before something else; signs
# that begin a contraction of one or two letters; characters of added tokens.  Above FRESH: the first of a text.
S_LETTER, S_DIGIT, S_SIGN, S_BLANK, S_LAST_SPACE, S_LAST_BLANK, S_SHORT, S_LONG, S_ADDED, S_ADDED_REST = range(10)
FRESH, IDLE = 10, 20


def cutter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a piece begins at the character) by symbol and state."""
    # What a symbol goes on with (a state to which it then belongs), and where it leads if it begins a piece.
    goes_on = {
        S_LETTER: (LETTERS, PREFIX), S_DIGIT: (DIGITS, PREFIX), S_SIGN: (SIGNS, PREFIX), S_BLANK: (BLANKS,),
        S_SHORT: (SIGNS, PREFIX), S_LONG: (SIGNS, PREFIX),
    }
    leads = {
        S_LETTER: LETTERS, S_DIGIT: DIGITS, S_SIGN: SIGNS, S_BLANK: BLANKS, S_LAST_SPACE: PREFIX, S_LAST_BLANK: NOTHING,
        S_SHORT: ONE_LEFT, S_LONG: TWO_LEFT, S_ADDED: NOTHING, S_ADDED_REST: NOTHING,
    }
    state = np.zeros((IDLE + 1, 8), np.uint8)
    cut = np.zeros((IDLE + 1, 8), bool)
    for symbol, lead in leads.items():
        for s in range(8):
            state[symbol, s], cut[symbol, s] = lead, symbol != S_ADDED_REST
            if s in goes_on.get(symbol, ()):
                state[symbol, s] = SIGNS if symbol in (S_SHORT, S_LONG) else lead
                cut[symbol, s] = False
        state[symbol + FRESH], cut[symbol + FRESH] = lead, True
    for s, then in ((ONE_LEFT, NOTHING), (TWO_LEFT, ONE_LEFT)):  # the letters of a contraction
        state[S_LETTER, s], cut[S_LETTER, s] = then, False
    state[IDLE] = np.arange(8)  # fills up the last chunk
    return state, cut


def symbols(points: np.ndarray, first: np.ndarray, classes: np.ndarray, added: list[tuple[int, int]]) -> np.ndarray:
    """The cutter's symbols of some texts' code points.  ``first`` marks where a text begins; ``added`` are the places of
    added tokens, which part what is before and after like texts."""
    first = first.copy()
    for a, b in added:
        first[a] = True
        if b < len(first):
            first[b] = True
    last = np.append(first[1:], True)
    kind = classes[points]
    blank = kind >= SPACE
    more = np.append(blank[1:], True) | last
    out = kind.copy()  # the first three classes are their symbols
    out[blank] = np.where(more[blank], S_BLANK, np.where(kind[blank] == SPACE, S_LAST_SPACE, S_LAST_BLANK))
    marks = np.flatnonzero((points == ord("'")) & ~last)
    one = np.append(points, [0, 0])[marks + 1]
    two = np.where(last[marks + 1], 0, np.append(points, [0, 0])[marks + 2])
    for ending in CONTRACTIONS:
        if len(ending) == 1:
            out[marks[one == ord(ending)]] = S_SHORT
        else:
            out[marks[(one == ord(ending[0])) & (two == ord(ending[1]))]] = S_LONG
    for a, b in added:
        out[a], out[a + 1 : b] = S_ADDED, S_ADDED_REST
    out[first] += FRESH
    return out


def cuts(symbol: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Whether a piece begins at each symbol: chunk maps, their prefix scan, and one more pass with the states known."""
    state, cut = cutter()
    state, cut = state.ravel(), cut.ravel()
    count = -(-len(symbol) // chunk)
    base = np.full(count * chunk, IDLE, np.intp)
    base[: len(symbol)] = symbol
    base = base.reshape(count, chunk).T * 8
    maps = np.tile(np.arange(8, dtype=np.uint8), (count, 1))
    for step in base:
        maps = state[step[:, None] + maps]
    reach = 1
    while reach < count:  # maps[i] covers the chunks i - reach + 1 to i
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), 1)
        reach *= 2
    now = np.zeros(count, np.uint8)
    now[1:] = maps[:-1, NOTHING]
    out = np.empty((chunk, count), bool)
    for i, step in enumerate(base):
        at = step + now
        out[i], now = cut[at], state[at]
    return out.T.ravel()[: len(symbol)]


# -- compiling -------------------------------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The bytes by the letters that vocabulary files write them with: themselves where printable, else from 256 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def character_classes(pre_tokenizer) -> np.ndarray:
    """The class of every code point, as the tokenizer's own pattern has it: what it joins a character to."""
    classes = np.full(_POINTS, BLANK, np.uint8)
    points = np.array([p for p in range(_POINTS) if not 0xD800 <= p < 0xE000])
    for low in range(0, len(points), 1 << 16):
        part = points[low : low + (1 << 16)]
        text = "".join(f"a{c}1{c}!{c}\n" for c in map(chr, part))
        begins = np.zeros(len(text), bool)
        begins[[where[0] for _, where in pre_tokenizer.pre_tokenize_str(text)]] = True
        joined = ~begins.reshape(len(part), 7)[:, [1, 3, 5]]
        for kind in (LETTER, DIGIT, SIGN):
            classes[part[joined[:, kind]]] = kind
    classes[ord(" ")] = SPACE
    return classes


@cache
def compiled(path: str) -> dict:
    """The tables of a tokenizer file, for broadcasting. Compiled once a driver: the classes of all code points take seconds."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    model, cutting = told["model"], told["pre_tokenizer"] or {}
    plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if (
        model["type"] != "BPE"
        or any(model.get(name) for name in plain)
        or told["normalizer"]
        or (cutting.get("type"), cutting.get("add_prefix_space"), cutting.get("use_regex", True)) != ("ByteLevel", False, True)
        or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in told["added_tokens"])
    ):
        raise ValueError(f"not a plain byte-level tokenizer: {path}")

    letter = _byte_letters()
    added = [t["content"].encode() for t in told["added_tokens"]]
    names = {name: number for name, number in model["vocab"].items() if name.encode() not in added}
    spelled = {number: bytes(letter[c] for c in name) for name, number in names.items()}
    merges, made = {}, {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        a, b, whole = names[left], names[right], names[left + right]
        if whole in made or any(len(spelled[x]) > 1 and x not in made for x in (a, b)):
            raise ValueError("a token is merged in two ways, or before its parts")
        merges[a, b] = rank
        made[whole] = (a, b, rank)

    counter = Counter({"merges": merges, "made": made, "child": {}, "token": [-1], "inner": [True], "added": added})
    child, token, inner = {}, [-1], [True]
    for number, name in spelled.items():
        if not counter.stands(number):  # merges never lead to it
            continue
        node = 0
        for byte in name:
            inner[node] = True
            following = child.get(node << 8 | byte)
            if following is None:
                following = child[node << 8 | byte] = len(token)
                token.append(-1)
                inner.append(False)
            node = following
        token[node] = number
    if any(byte not in child for byte in range(256)):
        raise ValueError("the vocabulary lacks a byte")
    classes = character_classes(Tokenizer.from_file(path).pre_tokenizer)
    return {"merges": merges, "made": made, "child": child, "token": token, "inner": inner, "added": added, "classes": classes}


# -- the counter -----------------------------------------------------------------------------------------------

_NEVER = 1 << 60


class Counter:
    """The transducer over the bytes of a piece, compiled as it is used."""

    def __init__(self, tables: dict, states: int = STATES):
        self.merges, self.made = tables["merges"], tables["made"]
        self.child, self.token, self.inner = tables["child"], tables["token"], tables["inner"]
        self.most = states
        self.edges: tuple[dict, dict] = ({}, {})
        self.beside: dict[tuple[int, int], bool] = {}
        self.known = {name: 1 for name in tables["added"]}
        self.fresh = dict(self.known)
        self._restart()

    def _restart(self) -> None:
        self.arcs: dict[int, int] = {}
        self.numbers: dict[tuple, int] = {}
        self.entries: list[tuple] = []
        self.left: list[int] = []  # tokens not yet emitted, by state
        self._number(((0, -1, 0),))

    def _number(self, entries: tuple) -> int:
        number = self.numbers.get(entries)
        if number is None:
            number = self.numbers[entries] = len(self.entries)
            self.entries.append(entries)
            self.left.append(entries[-1][2])
        return number

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The tokens that stand at one edge (0: left, 1: right) while ``token`` is merged, each with the rank that ends it."""
        found = self.edges[side].get(token)
        if found is None:
            found = [(token, _NEVER)]
            if token in self.made:
                part, rank = self.made[token][side], self.made[token][2]
                found = [*self._edge(part, side)[:-1], (part, rank), (token, _NEVER)]
            self.edges[side][token] = found
        return found

    def _across(self, left: int, right: int) -> int:
        """The rank of the first merge across the border of two tokens, ``_NEVER`` if there is none.

        Ranks only rise while merges go on, so the tokens at the border are known at each rank. Of equal merges that
        overlap the leftmost comes first."""
        before, after = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = before[i], after[j]
            rank = self.merges.get((a, b), _NEVER)
            if rank < a_ends and rank <= b_ends:
                return rank
            if a_ends <= b_ends:
                if a_ends == _NEVER:
                    return _NEVER
                i += 1
            else:
                j += 1

    def stands(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as this token."""
        if token not in self.made:
            return True
        left, right, rank = self.made[token]
        return self._across(left, right) == rank and self.stands(left) and self.stands(right)

    def _may_follow(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        found = self.beside.get((left, right))
        if found is None:
            if len(self.beside) > 4 * self.most:
                self.beside.clear()
            found = self.beside[left, right] = self._across(left, right) == _NEVER
        return found

    def _compile(self, state: int, byte: int) -> int:
        """The arc of a state and a byte: next state and tokens emitted."""
        moved, ended = [], None
        for node, before, count in self.entries[state]:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token[node]
            if ended is None and token >= 0 and self._may_follow(before, token):
                ended = (0, token, count + 1)
            if self.inner[node]:
                moved.append((node, before, count))
        moved.append(ended)
        emitted = min(count for _, _, count in moved)
        entries = tuple((node, before, count - emitted) for node, before, count in moved)
        if len(self.entries) >= self.most:
            self._restart()
            return self._number(entries) << 10 | emitted
        arc = self.arcs[state << 8 | byte] = self._number(entries) << 10 | emitted
        return arc

    def tokens(self, piece: bytes) -> int:
        """The number of tokens of a piece."""
        state = total = 0
        for byte in piece:
            arc = self.arcs.get(state << 8 | byte)
            if arc is None:
                arc = self._compile(state, byte)
            total += arc & 1023
            state = arc >> 10
        return total + self.left[state]

    def counted(self, data: bytes, begin: list[int]) -> list[int]:
        """Tokens of the pieces of ``data`` that begin at the given places."""
        known, out = self.known, []
        for a, b in zip(begin, [*begin[1:], len(data)], strict=True):
            piece = data[a:b]
            count = known.get(piece)
            if count is None:
                count = self.tokens(piece)
                if b - a <= LONG:
                    if len(known) >= PIECES:
                        known = self.known = dict(self.fresh)
                    known[piece] = count
            out.append(count)
        return out


def _added_in(data: bytes, offsets: np.ndarray, added: list[bytes], lead: np.ndarray) -> list[tuple[int, int]]:
    """Places of added tokens, as characters: leftmost first, of those the longest, none across texts."""
    found = []
    for name in added:
        at = data.find(name)
        while at >= 0:
            if np.searchsorted(offsets, at, "right") == np.searchsorted(offsets, at + len(name) - 1, "right"):
                found.append((at, -len(name)))
            at = data.find(name, at + 1)
    out, end = [], 0
    for at, size in sorted(found):
        if at >= end:
            end = at - size
            out.append((int(np.searchsorted(lead, at)), int(np.searchsorted(lead, end))))
    return out


def counts(raw: np.ndarray, offsets: np.ndarray, tables: dict) -> np.ndarray:
    """Tokens of each of some texts, given as UTF-8 with their offsets."""
    data = raw.tobytes()
    if not data:
        return np.zeros(len(offsets) - 1, np.int64)
    if "counter" not in tables:
        tables["counter"] = Counter(tables)  # stays with the worker's copy of the broadcast
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    first = np.zeros(len(points), bool)
    first[np.searchsorted(lead, offsets[:-1][np.diff(offsets) > 0])] = True
    added = _added_in(data, offsets, tables["added"], lead)
    begin = lead[cuts(symbols(points, first, tables["classes"], added))]
    total = np.cumsum([0, *tables["counter"].counted(data, begin.tolist())])
    return np.diff(total[np.searchsorted(begin, offsets)])


def _judge(batches: Iterator[pa.RecordBatch], text: int, tables: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for _, _, raw, offsets in slices(batch.column(text)):
            sizes.append(np.diff(offsets))
            found.append(counts(raw, offsets, tables))
        arrays = [*batch.columns, pa.array(np.concatenate(sizes), pa.int64()), pa.array(np.concatenate(found), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])


def token_counts(docs: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """The rows of docs with ``token_bytes`` (UTF-8 bytes of the text) and ``token_count``, by the tokenizer file at
    ``path`` (read by the driver only)."""
    own = [c for c in docs.columns if c not in ("token_bytes", "token_count")]
    plain = docs.select([F.col(f"`{c}`").alias(str(i)) for i, c in enumerate(own)])
    added = T._parse_datatype_string(RESULT).fields
    schema = T.StructType([*plain.schema.fields, *[T.StructField(str(len(own) + i), f.dataType) for i, f in enumerate(added)]])
    at = own.index(text_column)
    tables = docs.sparkSession.sparkContext.broadcast(compiled(path))
    judged = plain.mapInArrow(lambda batches: _judge(batches, at, tables.value), schema)
    return judged.toDF(*own, "token_bytes", "token_count")
