"""Places of values in JSON texts, by a structural index over a whole batch.

The texts of a batch lie one after the other in one array of bytes. Quotes and escapes (by the parity of runs of backslashes) give the
strings; the signs outside them, the strings and what fills the gaps between are the tokens of all texts; prefix sums
give their depths, and one sort by depth gives each token the bracket that holds it. The grammar is checked and paths are
resolved on these arrays, so there is no loop over rows and no recursion, however deep a text is nested.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # texts indexed at a time (a longer one alone)

_OPEN_O, _CLOSE_O, _OPEN_A, _CLOSE_A, _COMMA, _COLON, _STRING, _SCALAR, _NONE = range(9)
_OTHER = 255
_SIGN = np.full(256, _OTHER, np.uint8)
for _kind, _sign in enumerate('{}[],:"'):
    _SIGN[ord(_sign)] = _kind
_NAME = 9  # a string that is a name in an object
_ESCAPABLE, _HEX = np.zeros(256, bool), np.zeros(256, bool)
_ESCAPABLE[list(b'"\\/bfnrtu')] = True
_HEX[list(b"0123456789abcdefABCDEF")] = True
_SCALARS = r"^(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?|true|false|null)$"
_BLANKS = " \t\n\r"

PLACES = pa.list_(pa.struct([("rule", pa.int32()), ("value", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


class _Texts:
    """The bytes of some texts, and the check that a condition holds everywhere."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets

    def row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, "right") - 1

    def require(self, good: np.ndarray, at: np.ndarray) -> None:
        if not good.all():
            place = int(np.asarray(at)[~good][0])
            row = int(self.row(np.array([place]))[0])
            raise ValueError(f"malformed JSON in text {row} of the batch at byte {place - int(self.offsets[row])}")

    def pieces(self, start: np.ndarray, stop: np.ndarray) -> pa.Array:
        """The texts from start to stop; the ranges ascend and do not overlap."""
        bounds = np.empty(2 * len(start) + 1, np.int64)
        bounds[0:-1:2], bounds[1::2], bounds[-1] = start, stop, stop[-1] if len(stop) else 0
        all_ = pa.LargeStringArray.from_buffers(2 * len(start), pa.py_buffer(bounds), pa.py_buffer(self.data))
        return all_.take(pa.array(np.arange(0, 2 * len(start), 2)))


def _looked_up(table: np.ndarray, data: np.ndarray) -> np.ndarray:
    """table[data] of bytes; several times as fast as numpy's own."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), np.uint8)


def _escaped(texts: _Texts) -> tuple[np.ndarray, np.ndarray]:
    """Places of the backslashes that begin an escape and of the quotes they escape; refuses bad escapes."""
    data = texts.data
    slash = np.flatnonzero(data == ord("\\"))
    if not len(slash):
        return slash, slash
    run = np.ones(len(slash), bool)
    run[1:] = (np.diff(slash) != 1) | np.isin(slash[1:], texts.offsets)
    first = np.flatnonzero(run)
    starter = slash[(np.arange(len(slash)) - first[np.cumsum(run) - 1]) % 2 == 0]
    ends = texts.offsets[texts.row(starter) + 1]
    texts.require(starter + 1 < ends, starter)
    sign = data[starter + 1]
    texts.require(_ESCAPABLE[sign], starter)
    wide, ends = starter[sign == ord("u")], ends[sign == ord("u")]
    texts.require(wide + 5 < ends, wide)
    texts.require(_HEX[data[wide[:, None] + np.arange(2, 6)]].all(axis=1), wide)
    return starter, starter[sign == ord('"')] + 1


def _tokens(texts: _Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and kind of all tokens of all texts, in order, and the number of the first one of each text."""
    data, offsets = texts.data, texts.offsets
    kind = _looked_up(_SIGN, data)
    at = np.flatnonzero(kind != _OTHER)
    kind = kind[at]
    starter, quoted = _escaped(texts)
    quote = kind == _STRING
    if len(quoted):
        quote[np.searchsorted(at, quoted)] = False
    odd = np.cumsum(quote, dtype=np.int64) & 1 == 1  # in a string, or at its opening quote
    quotes = at[quote]
    texts.require(np.diff(np.searchsorted(quotes, offsets)) % 2 == 0, offsets[:-1])
    for never_outside, places in ((True, starter), (False, np.flatnonzero(data < 32))):
        texts.require((np.searchsorted(quotes, places) % 2 == 1) == never_outside, places)
    token = np.where(quote, odd, ~odd)
    start, kind = at[token], kind[token]
    stop = start + 1
    stop[kind == _STRING] = quotes[1::2] + 1
    # what lies before each token and behind the last one of each text
    first = np.searchsorted(start, offsets)
    before = np.empty(len(start), np.int64)
    before[1:] = stop[:-1]
    some = first[:-1] < first[1:]
    before[first[:-1][some]] = offsets[:-1][some]
    wide = np.flatnonzero(start > before)
    last = np.where(some, stop[np.maximum(first[1:], 1) - 1] if len(stop) else 0, offsets[:-1])
    open_ = np.flatnonzero(offsets[1:] > last)
    place = np.concatenate([wide, first[1:][open_]])
    order = np.argsort(place, kind="stable")  # of a text's end and the next one's beginning the end comes first
    tail = np.concatenate([np.zeros(len(wide), bool), np.ones(len(open_), bool)])
    order = order[np.lexsort((~tail[order], place[order]))] if len(open_) else order
    place = place[order]
    begin, end = np.concatenate([before[wide], last[open_]])[order], np.concatenate([start[wide], offsets[1:][open_]])[order]
    gap = texts.pieces(begin, end)
    left = pc.ascii_ltrim(gap, _BLANKS)
    trimmed = pc.ascii_rtrim(left, _BLANKS)
    length = pc.binary_length(trimmed).to_numpy(zero_copy_only=False)
    full = length > 0
    begin = (end - pc.binary_length(left).to_numpy(zero_copy_only=False))[full]
    length, place = length[full], place[full]
    texts.require(pc.match_substring_regex(trimmed.filter(pa.array(full)), _SCALARS).to_numpy(zero_copy_only=False).astype(bool), begin)
    start, stop = np.insert(start, place, begin), np.insert(stop, place, begin + length)
    return start, stop, np.insert(kind, place, _SCALAR), np.searchsorted(start, offsets)


def _holders(texts: _Texts, start: np.ndarray, opens: np.ndarray, closes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each token the number of the bracket that holds it (a closing one: its opening one), -1 at the top."""
    bracket = np.flatnonzero(opens | closes)
    opening = opens[bracket]
    after = np.cumsum(np.where(opening, 1, -1))
    inner = after + ~opening  # the depth inside the bracket
    texts.require(after >= 0, start[bracket])
    seen = np.searchsorted(bracket, first)  # brackets before each text, and all of them
    depth = np.concatenate([[0], after])[seen]
    texts.require(depth[1:] == 0, texts.offsets[:-1])
    # brackets in order of depth: openings and closings take turns
    order = np.argsort(inner.astype(np.uint16) if inner.max(initial=0) < 1 << 16 else inner, kind="stable")
    one, two = order[0::2], order[1::2]
    texts.require(opening[one] & ~opening[two], start[bracket[one]])
    # an opening bracket is held by the last opening one that is a level further out
    given = np.concatenate([inner[one], inner[one] - 1])
    number = np.concatenate([one, one])
    gives = np.concatenate([np.ones(len(one), bool), np.zeros(len(one), bool)])
    turn = np.lexsort((number, given))
    last = np.maximum.accumulate(np.where(gives[turn], np.arange(len(turn)), -1)) if len(turn) else turn
    asks = ~gives[turn] & (given[turn] > 0)
    outer = np.full(len(bracket), -1)
    outer[number[turn[asks]]] = number[turn[last[asks]]]
    outer[two] = outer[one]  # of a closing bracket: what holds the pair
    # any other token is held by the bracket before it, or by what holds that one, if it is a closing one
    holds = np.append(np.where(opening, np.arange(len(bracket)), outer), -1)
    flag = np.zeros(len(start), np.int64)
    flag[bracket] = 1
    latest = np.cumsum(flag) - 1 - flag
    holder = holds[latest]
    return np.append(bracket, -1)[holder]


def _allowed() -> np.ndarray:
    """Whether a token that is no name may stand in a bracket after another, by (kind * 10 + kind before) * 3 + bracket:
    0 for the top, 1 in an object, 2 in an array."""
    out = np.zeros((8, 10, 3), np.uint8)
    for kind in (_OPEN_O, _OPEN_A, _STRING, _SCALAR):
        out[kind, _NONE, 0] = out[kind, _COLON, 1] = out[kind, _OPEN_A, 2] = out[kind, _COMMA, 2] = 1
    out[_COLON, _NAME, 1] = out[_CLOSE_O, _OPEN_O, 1] = out[_CLOSE_A, _OPEN_A, 2] = 1
    for ended in (_STRING, _SCALAR, _CLOSE_O, _CLOSE_A):
        out[_COMMA, ended, 1:] = out[_CLOSE_O, ended, 1] = out[_CLOSE_A, ended, 2] = 1
    return np.append(out.ravel(), np.zeros(16, np.uint8))


_GRAMMAR = _allowed()


def find_places(data: np.ndarray, offsets: np.ndarray, paths: list[tuple[str, ...]]) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Row, rule, value, start and stop (in characters) of every value but null at the paths, in the order of the texts.

    data and offsets hold the texts' UTF-8 bytes, offsets from 0. A path is names and '*', the elements of an array; the value of a
    string is its content, of any other value its text. Where a path ends at an object or array that another path enters,
    only the other counts. ValueError if a text is malformed.
    """
    texts = _Texts(data, offsets)
    start, stop, kind, first = _tokens(texts)
    texts.require(np.diff(first) > 0, offsets[:-1])
    opens, closes = (kind == _OPEN_O) | (kind == _OPEN_A), (kind == _CLOSE_O) | (kind == _CLOSE_A)
    holder = _holders(texts, start, opens, closes, first)
    bracket = np.zeros(len(kind) + 1, np.uint8)  # what a token opens: 1 an object, 2 an array
    bracket[:-1][kind == _OPEN_O] = 1
    bracket[:-1][kind == _OPEN_A] = 2
    inside = bracket[holder]
    before = np.empty(len(kind), np.uint8)
    before[1:] = kind[:-1]
    before[first[:-1]] = _NONE
    in_object = inside == 1
    key = (kind == _STRING) & in_object & ((before == _OPEN_O) | (before == _COMMA))
    before[1:][key[:-1]] = _NAME
    texts.require((_looked_up(_GRAMMAR, (kind * np.uint8(10) + before) * np.uint8(3) + inside) == 1) | key, start)

    value = (opens | (kind >= _STRING)) & ~key
    at = np.flatnonzero(value)
    names = list(dict.fromkeys(step for path in paths for step in path))
    name = _names(texts, start, stop, at, in_object, names)
    starred = names.index("*") if "*" in names else -2
    name[inside[at] == 2] = starred
    number = np.full(len(kind) + 1, -1)  # of a token among the values; of the top: the last place
    number[at] = np.arange(len(at))
    parent = np.where(holder[at] >= 0, number[holder[at]], -1)
    ends = stop.copy()
    ends[holder[closes]] = stop[closes]

    rule = np.full(len(at), -1)
    entered = np.zeros(len(at), bool)
    for r, path in enumerate(paths):
        met = parent < 0
        for step in path:
            entered |= met & opens[at]
            met = np.append(met, False)[parent] & (parent >= 0) & (name == names.index(step))
        rule[met] = r
    null = (kind[at] == _SCALAR) & (data[start[at]] == ord("n"))
    found = at[(rule >= 0) & ~entered & ~null]
    rule = rule[(rule >= 0) & ~entered & ~null]
    begin, end = start[found], ends[found]
    wide = np.flatnonzero((data & 0xC0) == 0x80)  # bytes that are not a character of their own
    row = np.searchsorted(first, found, "right") - 1
    base = offsets[row]

    def place(byte: np.ndarray) -> np.ndarray:
        return byte - base - (np.searchsorted(wide, byte) - np.searchsorted(wide, base))

    return row, rule, _values(texts, begin, end, kind[found] == _STRING), place(begin), place(end)


def _names(texts: _Texts, start: np.ndarray, stop: np.ndarray, at: np.ndarray, in_object: np.ndarray, names: list[str]) -> np.ndarray:
    """For each value in an object the number of its name among `names`, else -1."""
    out = np.full(len(at), -1)
    named = np.flatnonzero(in_object[at])
    if not len(named):
        return out
    keys = at[named] - 2  # before the colon
    length = stop[keys] - start[keys] - 2
    sizes = np.zeros(max((len(n.encode()) for n in names), default=0) + 2, bool)
    sizes[[len(n.encode()) for n in names]] = True
    likely = sizes[np.minimum(length, len(sizes) - 1)]
    slash = np.flatnonzero(texts.data == ord("\\"))
    if len(slash):
        likely |= np.searchsorted(slash, start[keys]) < np.searchsorted(slash, stop[keys])
    named, keys = named[likely], keys[likely]
    text = texts.pieces(start[keys] + 1, stop[keys] - 1)
    known = pc.index_in(text, pa.array(names, pa.large_string())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    for i in np.flatnonzero(pc.match_substring(text, "\\").to_numpy(zero_copy_only=False)) if len(slash) else ():
        name = json.loads(f'"{text[int(i)].as_py()}"')
        known[i] = names.index(name) if name in names else -1
    out[named] = known
    return out


def _values(texts: _Texts, begin: np.ndarray, end: np.ndarray, is_string: np.ndarray) -> list[str]:
    """The content of strings, the text of other values."""
    raw = texts.data.tobytes() if len(begin) else b""
    out = [raw[a:b].decode() for a, b in zip((begin + is_string).tolist(), (end - is_string).tolist(), strict=True)]
    for i in np.flatnonzero(is_string):
        if "\\" in out[i]:
            out[i] = json.loads(f'"{out[i]}"')
    return out


def json_places(texts: pa.Array, paths: list[tuple[str, ...]], limit: int = SLICE_BYTES) -> pa.Array:
    """For each text the list of its places (rule, value, start, stop) as find_places gives them; null for a null text."""
    texts = texts.cast(pa.large_string())
    full = pc.fill_null(texts, "null")
    offsets = np.frombuffer(full.buffers()[1], np.int64)[full.offset : full.offset + len(full) + 1]
    data = np.frombuffer(full.buffers()[2], np.uint8) if len(full) else np.zeros(0, np.uint8)
    parts, at = [], 0
    while at < len(full):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        row, *rest = find_places(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], paths)
        parts.append((row + at, *rest))
        at = to
    row, rule, start, stop = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1, 3, 4))
    fields = [pa.array(rule, pa.int32()), pa.array([v for p in parts for v in p[2]], pa.string()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())]
    first = np.searchsorted(row, np.arange(len(full) + 1)).astype(np.int32)
    listed = pa.StructArray.from_arrays(fields, fields=list(PLACES.value_type))
    return pa.ListArray.from_arrays(pa.array(first), listed, mask=texts.is_null() if texts.null_count else None, type=PLACES)
