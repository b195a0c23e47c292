"""Aho-Corasick over UTF-8: all words of a list, of any script and with blanks, found in one pass over each text.

The automaton is three numpy tables: where each state goes on each byte, whether a word ends there, and where to look for further words that end at the
same place. Texts are not walked one after another but side by side: a batch's bytes are cut into lanes that overlap by one byte less than the longest
word, and a step of numpy takes all lanes one byte further. Bytes that occur in no word are one class, so a row of the table is as wide as the
words' alphabet. A list whose table would be too large is dealt over several automata.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Cells of an automaton's table (4 bytes each), and bytes of a lane.
_CELLS, _LANE = 16 << 20, 512


class Automaton:
    """Finds which of some words, as bytes, stand in texts."""

    def __init__(self, words: Sequence[bytes]) -> None:
        used = np.zeros(256, dtype=bool)
        for w in words:
            used[list(w)] = True
        self.classes = np.zeros(256, dtype=np.int32)
        self.classes[used] = np.arange(1, used.sum() + 1)
        width = int(used.sum()) + 1
        children: list[dict[int, int]] = [{}]
        ends, self.longest = [-1], max(map(len, words), default=1)
        for number, w in enumerate(words):
            at = 0
            for c in self.classes[list(w)].tolist():
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][c]
            ends[at] = number
        self.next = np.zeros((len(children), width), dtype=np.int32)
        self.ends = np.array(ends, dtype=np.int32)
        #: the next shorter suffix of a state at which a word ends, or 0
        self.further = np.zeros(len(children), dtype=np.int32)
        fail = np.zeros(len(children), dtype=np.int32)
        level = [0]
        while level:  # by depth: a state's fallback is shorter than the state
            below = []
            for at in level:
                row = self.next[fail[at]].copy() if at else np.zeros(width, dtype=np.int32)
                for c, child in children[at].items():
                    fail[child] = row[c]
                    row[c] = child
                    self.further[child] = fail[child] if self.ends[fail[child]] >= 0 else self.further[fail[child]]
                    below.append(child)
                self.next[at] = row
            level = below
        self.stops = (self.ends >= 0) | (self.further > 0)

    def find(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and word of each pair of which the text holds the word, each pair once, in order; texts are ``data`` cut at ``offs``."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = np.diff(offs)
        lanes = -(-size // _LANE)
        text = np.repeat(np.arange(len(size)), lanes)
        first = offs[:-1][text] + (np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)) * _LANE
        end = np.minimum(first + _LANE, offs[1:][text])
        begin = np.maximum(first - (self.longest - 1), offs[:-1][text])
        order = np.argsort(begin - end, kind="stable")  # longest first, so that the lanes still walking are a prefix
        text, at, end = text[order], begin[order], end[order]
        steps = end - at
        walking = np.searchsorted(-steps, -np.arange(int(steps[0]) if len(steps) else 0), "left")
        coded = self.classes[data]
        state = np.zeros(len(text), dtype=np.int32)
        places, states = [], []
        for k, n in enumerate(walking.tolist()):
            state[:n] = self.next[state[:n], coded[at[:n] + k]]
            hit = np.flatnonzero(self.stops[state[:n]])
            if len(hit):
                places.append(text[hit])
                states.append(state[hit])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(places).astype(np.int64) * len(self.ends) + np.concatenate(states))
        place, at_state = np.divmod(pairs, len(self.ends))
        found, owner = [], []
        while len(at_state):  # all words that end there, from the longest to the shortest
            word = self.ends[at_state]
            found.append(word[word >= 0])
            owner.append(place[word >= 0])
            more = self.further[at_state] > 0
            place, at_state = place[more], self.further[at_state[more]]
        key = np.unique(np.concatenate(owner) * (1 << 32) + np.concatenate(found))
        return key >> 32, key & 0xFFFFFFFF


def dealt(words: Sequence[str]) -> Iterator[tuple[int, Automaton]]:
    """The first word's number and an automaton of each part of the list whose table is of bounded size."""
    coded = [w.encode() for w in words]
    start, states, used = 0, 1, set()
    for k, w in enumerate(coded):
        wider = used | set(w)
        if k > start and (states + len(w)) * (len(wider) + 1) > _CELLS:
            yield start, Automaton(coded[start:k])
            start, states, wider = k, 1, set(w)
        states, used = states + len(w), wider
    if start < len(coded):
        yield start, Automaton(coded[start:])


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes and where each begins, without a copy; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    offs = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[offs[0] : offs[-1]], offs - offs[0]
