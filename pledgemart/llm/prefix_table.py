"""Last tokens of the prefixes of many short strings at once, for merge-type (BPE) vocabularies.

A vocabulary joins, again and again, the two neighbours whose joined token has the lowest rank (of equal
ranks the pair further left). Then the encoding of a prefix without its last token is the encoding of a
shorter prefix, and one token per prefix tells all. The last token of a prefix is the one that ends
there and fits behind the last token of the prefix before it.

Tokens that end at a place come from an Aho-Corasick automaton, the longest first; ``fits`` tests a pair
by merging both side by side. All strings of a batch take their next symbol in the same numpy step.
Before, strings are cut where no token can span (two symbols that stand side by side in no token are
never merged), and equal parts are taken together.
"""

from __future__ import annotations

from array import array

import numpy as np

from pledgemart.llm.common import mix, span_hashes

_NEVER = 1 << 40
#: Parts longer than this are walked alone, one symbol after the other.
LONG = 64
#: Pairs whose test is remembered.
_SLOTS = 1 << 20


class PrefixTable:
    """``tokens``: strings and ids (below 2^24); ``ranks``: when strings of two or more symbols are made by a merge.

    With ``whole`` a string that is itself a token is that token, also if its symbols do not merge to it.
    """

    def __init__(self, tokens: dict[str, int], ranks: dict[str, int], whole: bool = False):
        self.ranks, self.whole = ranks, whole
        self.strings, self._ids, self._most = {i: s for s, i in tokens.items()}, tokens, max(map(len, tokens), default=0)
        joined = [s for s in tokens if len(s) > 1]
        symbols = sorted({c for s in joined for c in s})
        if missing := [c for c in symbols if c not in tokens]:
            raise ValueError(f"not tokens themselves: {missing[:5]}")
        most = max(map(ord, "".join(tokens)), default=0) + 2
        #: Symbols of longer tokens have a class; all others, class 0, are tokens of their own or unknown.
        self._classes = np.zeros(most, np.int64)
        self._single = np.full(most, -1, np.int32)
        for n, c in enumerate(symbols, 1):
            self._classes[ord(c)] = n
        for s, i in tokens.items():
            if len(s) == 1:
                self._single[ord(s)] = i
        self._k = len(symbols) + 1
        self._span = np.zeros((self._k, self._k), bool)
        size = max(self.strings, default=0) + 1
        self._sizes = np.zeros(size, np.int64)
        self._alone = np.full(size, -1, np.int8)
        for s, i in tokens.items():
            self._sizes[i] = len(s)
        self._automaton({c: tokens[c] for c in symbols} | {s: tokens[s] for s in joined})
        self._keys, self._values = np.full(_SLOTS, -1, np.int64), np.zeros(_SLOTS, bool)
        self._runs: dict[int, tuple] = {}
        self._lists: list = []  # the automaton for single steps, made when needed

    def _automaton(self, tokens: dict[str, int]) -> None:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for s, i in tokens.items():
            node, codes = 0, self._classes[[ord(c) for c in s]].tolist()
            for code in codes:
                after = children[node].get(code)
                if after is None:
                    after = children[node][code] = len(children)
                    children.append({})
                    ends.append(-1)
                node = after
            ends[node] = i
            self._span[codes[:-1], codes[1:]] = True
        fail, nearest, link = [0] * len(children), [0] * len(children), [0] * len(children)
        row = list(children[0].values())
        for node in row:
            nearest[node] = node
        while row:
            below = []
            for node in row:
                for code, child in children[node].items():
                    back = fail[node]
                    while back and code not in children[back]:
                        back = fail[back]
                    fail[child] = children[back].get(code, 0)
                    link[child] = nearest[fail[child]]
                    nearest[child] = child if ends[child] >= 0 else link[child]
                    below.append(child)
            row = below
        edges = sorted((node * self._k + code, child) for node, held in enumerate(children) for code, child in held.items())
        self._edges = np.array([e for e, _ in edges], np.int64)
        self._child = np.array([c for _, c in edges], np.int64)
        self._fail, self._nearest, self._link, self._ends = (np.array(x, np.int64) for x in (fail, nearest, link, ends))

    def run(self, token: int) -> tuple[bool, list, list]:
        """Whether the token's symbols merge to it, and what its left and its right end are after each merge.

        Both lists begin with the first or last symbol at rank -1; then, for each merge in turn, its rank
        and the part that is at the edge behind it.
        """
        if (known := self._runs.get(token)) is not None:
            return known
        parts = list(self.strings[token])
        left, right = [(-1, parts[0])], [(-1, parts[-1])]
        while len(parts) > 1:
            ranks = [self.ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(ranks)
            if least == _NEVER:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            left.append((least, parts[0]))
            right.append((least, parts[-1]))
        known = self._runs[token] = (len(parts) == 1, left, right)
        return known

    def fits(self, first: int, second: int) -> bool:
        """Whether the symbols of both, merged together, end as just the two.

        Both merge side by side, the next step being the one of lower rank. They stay apart unless at some
        time the two parts at the seam make a token that comes before the next step of either; of equal
        ranks a step within the first comes before the seam, and the seam before one within the second.
        """
        whole_a, _, a = self.run(first)
        whole_b, b, _ = self.run(second)
        if not (whole_a and whole_b):
            return False
        i = j = 0
        while True:
            next_a = a[i + 1][0] if i + 1 < len(a) else _NEVER
            next_b = b[j + 1][0] if j + 1 < len(b) else _NEVER
            seam = self.ranks.get(a[i][1] + b[j][1])
            if seam is not None and seam < next_a and seam <= next_b:
                return False
            if next_a == next_b == _NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def _fit(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``fits`` of many pairs."""
        key = first.astype(np.int64) << 24 | second
        slot = (mix(key.view(np.uint64)) % np.uint64(_SLOTS)).astype(np.int64)
        known, out = self._keys[slot] == key, self._values[slot]
        if not known.all():
            missed = ~known
            new, back = np.unique(key[missed], return_inverse=True)
            found = np.fromiter((self.fits(x >> 24, x & 0xFFFFFF) for x in new.tolist()), bool, len(new))
            out[missed] = found[back]
            slot = (mix(new.view(np.uint64)) % np.uint64(_SLOTS)).astype(np.int64)
            self._keys[slot] = new
            self._values[slot] = found
        return out

    def _stands(self, token: np.ndarray) -> np.ndarray:
        """Whether tokens stand for the whole of their symbols."""
        for i in np.unique(token[self._alone[token] < 0]).tolist():
            self._alone[i] = self.run(i)[0]
        return self._alone[token] == 1

    def _step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The automaton's next states."""
        out, left = np.zeros(len(state), np.int64), np.arange(len(state))
        while len(left):
            key = state * self._k + code[left]
            at = np.minimum(np.searchsorted(self._edges, key), len(self._edges) - 1)
            hit = self._edges[at] == key
            out[left[hit]] = self._child[at[hit]]
            again = ~hit & (state != 0)
            left, state = left[again], self._fail[state[again]]
        return out

    def _short(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of parts behind one another, how many each has, and the token of its symbols if they do not merge to it, else -1.

        ``codes`` are classes.
        """
        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        active = len(sizes) - np.searchsorted(sizes[::-1], np.arange(sizes[0]), "right")  # parts longer than j
        last = np.zeros((int(sizes[0]), len(sizes)), np.int32)
        state, unmade = np.zeros(len(sizes), np.int64), np.full(len(sizes), -1, np.int32)
        for j, n in enumerate(active.tolist()):
            state = self._step(state[:n], codes[starts[:n] + j])
            left, node = np.arange(n), self._nearest[state]
            while len(left):
                token = self._ends[node]
                before = j - self._sizes[token]
                inner = before >= 0
                fit = np.empty(len(left), bool)
                fit[inner] = self._fit(last[before[inner], left[inner]], token[inner])
                fit[~inner] = self._stands(token[~inner])
                odd = ~inner & ~fit
                odd[odd] = sizes[left[odd]] == j + 1
                unmade[left[odd]] = token[odd]
                last[j, left[fit]] = token[fit]
                left, node = left[~fit], self._link[node[~fit]]
        # Read off from the ends, the k-th last token of all parts at a time.
        taken, at, which = [], sizes - 1, np.arange(len(sizes))
        while len(which):
            token = last[at, which]
            taken.append((which, token))
            at = at - self._sizes[token]
            which, at = which[at >= 0], at[at >= 0]
        counts = np.bincount(np.concatenate([w for w, _ in taken]), minlength=len(sizes))
        into = np.empty(len(sizes), np.int64)  # ends, in the order of the parts that were given
        given = np.empty(len(sizes), np.int64)
        given[order] = counts
        into[:] = np.cumsum(given)[order]
        out = np.empty(int(given.sum()), np.int32)
        for k, (w, token) in enumerate(taken, 1):
            out[into[w] - k] = token
        back = np.empty(len(sizes), np.int32)
        back[order] = unmade
        return out, given, back

    def _long(self, codes: np.ndarray) -> np.ndarray:
        """Ids of one part of any length, symbol after symbol."""
        if not self._lists:
            edges = dict(zip(self._edges.tolist(), self._child.tolist(), strict=True))
            self._lists.extend((edges, *(x.tolist() for x in (self._fail, self._nearest, self._link, self._ends, self._sizes))))
        edges, fail, nearest, link, ends, sizes = self._lists
        last, state, known, k = array("i"), 0, {}, self._k
        for j, code in enumerate(codes.tolist()):
            while (after := edges.get(state * k + code)) is None and state:
                state = fail[state]
            state = after or 0
            node = nearest[state]
            while True:
                token = ends[node]
                before = j - sizes[token]
                pair = (last[before] if before >= 0 else -1, token)
                if (fit := known.get(pair)) is None:
                    fit = known[pair] = self.fits(*pair) if before >= 0 else self.run(token)[0]
                if fit:
                    break
                node = link[node]
            last.append(token)
            if len(known) > _SLOTS:
                known.clear()
        out, end = array("i"), len(last) - 1
        while end >= 0:
            out.append(last[end])
            end -= sizes[last[end]]
        return np.frombuffer(out, np.int32)[::-1]

    def spans(self, text: str, at: int) -> bool:
        """Whether a token can span the places before and at ``at``."""
        a, b = (int(self._classes[c]) if (c := ord(text[i])) < len(self._classes) else 0 for i in (at - 1, at))
        return bool(self._span[a, b])

    def encode(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings that lie behind one another in ``symbols`` (code points), and how many each has.

        ``starts`` are their beginnings, ascending, from 0; none is empty. An unknown symbol s gets the id -1 - s.
        """
        if not len(symbols):
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
        symbols = np.ascontiguousarray(symbols, "<u4")
        held = np.minimum(symbols, len(self._classes) - 1)  # the last place is no symbol
        codes = self._classes[held]
        cut = np.ones(len(symbols), bool)
        cut[1:] = ~self._span[codes[:-1], codes[1:]]
        cut[starts] = True
        begins = np.flatnonzero(cut)
        sizes = np.diff(np.append(begins, len(symbols)))
        counts = np.ones(len(begins), np.int64)
        some, many = np.flatnonzero((sizes > 1) & (sizes <= LONG)), np.flatnonzero(sizes > LONG).tolist()
        if len(some):
            ids, per_part, kind, unmade = self._distinct(symbols, codes, begins[some], sizes[some])
            if self.whole and (unmade >= 0).any():
                strings = np.isin(begins[some], starts) & np.isin(begins[some] + sizes[some], np.append(starts, len(symbols)))
                odd = np.flatnonzero(strings & (unmade[kind] >= 0))
                token = unmade[kind[odd]]
                kind[odd] = len(per_part) + np.arange(len(odd))
                ids, per_part = np.append(ids, token), np.append(per_part, np.ones(len(odd), np.int64))
            counts[some] = per_part[kind]
        alone = {}
        for i in many:
            begin, end = int(begins[i]), int(begins[i] + sizes[i])
            string = self.whole and end - begin <= self._most and begin in starts and (end == len(symbols) or end in starts)
            token = self._ids.get("".join(map(chr, symbols[begin:end].tolist()))) if string else None
            alone[i] = self._long(codes[begin:end]) if token is None else np.array([token], np.int32)
        for i, found in alone.items():
            counts[i] = len(found)
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]), np.int32)
        one = np.flatnonzero(sizes == 1)
        token, symbol = self._single[held[begins[one]]], symbols[begins[one]].astype(np.int64)
        out[ends[one] - 1] = np.where(token < 0, -1 - symbol, token)
        if len(some):
            n = counts[some]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            source = (np.cumsum(per_part) - per_part)[kind]
            out[np.repeat(ends[some] - n, n) + step] = ids[np.repeat(source, n) + step]
        for i, found in alone.items():
            out[ends[i] - len(found) : ends[i]] = found
        total = np.append(0, ends)
        bounds = np.searchsorted(begins, np.append(starts, len(symbols)))
        return out, np.diff(total[bounds])

    def _distinct(self, symbols: np.ndarray, codes: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple:
        """Ids and counts of the distinct parts, which of them each part is, and tokens that are not merged to."""
        hashes = span_hashes(symbols.view(np.uint8), 4 * begins, 4 * (begins + sizes))
        _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
        # Parts of equal hashes are compared; one that differs stands for itself.
        model = first[kind]
        step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        same = sizes == sizes[model]
        to = np.repeat(np.where(same, begins[model], begins), sizes) + step
        equal = symbols[np.repeat(begins, sizes) + step] == symbols[to]
        same &= np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes)
        odd = np.flatnonzero(~same)
        kind[odd] = len(first) + np.arange(len(odd))
        first = np.append(first, odd)
        ids, per_part, unmade = self._short(codes, begins[first], sizes[first])
        return ids, per_part, kind, unmade
