"""Plain versions of the operators' results, for small inputs."""

import hashlib
import math
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_counts(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            covered |= set(range(i, i + 8))
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered)


def passages(docs, span, text=False):
    """doc_id -> (bytes, removed, runs, sha256 of the rest), or the rest as text, without characters that were cut"""
    as_text = text
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - span + 1):
            w = b[i : i + span]
            if w in seen:
                gone[i : i + span] = [True] * span
            seen.add(w)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out[doc_id] = rest.decode("utf-8", "ignore") if as_text else (len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def shingles(text, width=5):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def classes(ids, linked):
    """id -> smallest id reachable"""
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def grams(text, order):
    line = ("begin",) * (order - 1) + tuple(text) + ("end",)
    return [line[i : i + order] for i in range(len(line) - order + 1)]


def kneser_ney(texts, order=4):
    """log p(symbol | up to three symbols before) of an interpolated modified Kneser-Ney model, as a function of tuples"""
    counts = {order: Counter(g for t in texts for g in grams(t, order))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts, contexts = {}, {}
    for n, c in counts.items():
        k = Counter(c.values())
        if any(not k[i] for i in (1, 2, 3, 4)):
            discounts[n] = [0, 0.5, 1.0, 1.5]
        else:
            y = k[1] / (k[1] + 2 * k[2])
            discounts[n] = [0] + [min(max(i - (i + 1) * y * k[i + 1] / k[i], 0.0), i) for i in (1, 2, 3)]
        by = {}
        for g, v in c.items():
            total, mass = by.get(g[:-1], (0, 0.0))
            by[g[:-1]] = total + v, mass + discounts[n][min(v, 3)]
        contexts[n] = by

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        lower = p(g[1:])
        if g[:-1] not in contexts[n]:
            return lower
        total, mass = contexts[n][g[:-1]]
        v = counts[n][g]
        return max(v - discounts[n][min(v, 3)], 0) / total + mass / total * lower

    return lambda text: -sum(math.log(p(g)) for g in grams(text, order)) / (len(text) + 1)


def piece_weights(path, alpha):
    """Weights of the pieces that make text, by piece and by id; pieces of bytes weigh as much as the last rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    last = -alpha * math.log(1 + model.get_piece_size())
    by_piece, by_id = {}, {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            by_id[i] = last
        elif not (model.is_control(i) or model.is_unknown(i)):
            by_piece[model.id_to_piece(i)] = by_id[i] = max(-alpha * math.log(1 + max(-model.get_score(i), 0.0)), last)
    return by_piece, by_id, last


def lattice_mass(text, weights):
    """The logarithm of the summed weights of all segmentations of a text; no piece reaches over a word's beginning."""
    by_piece, _, last = weights
    longest = max(map(len, by_piece))
    whole, mass = [(" " + text)[i] for i in range(len(text) + 1)] if text else [], 0.0
    words = re.findall(r"\n| +[^ \n]*|[^ \n]+", "".join(whole))
    known = {}
    for word in words:
        if word not in known:
            total = [0.0]
            for j in range(1, len(word) + 1):
                ways = []
                for i in range(max(0, j - longest), j):
                    part = word[i:j]
                    w = None if "\u2581" in part else by_piece.get(part.replace(" ", "\u2581"))
                    if w is None and j == i + 1:
                        w = last * len(part.encode())
                    if w is not None:
                        ways.append(total[i] + w)
                top = max(ways)
                total.append(top + math.log(sum(math.exp(w - top) for w in ways)))
            known[word] = total[-1]
        mass += known[word]
    return mass


def spelled(ids, parts):
    return b"".join(parts[i] for i in ids).decode().removeprefix(" ")
