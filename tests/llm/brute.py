"""Plain single-machine versions of the operators, for comparison."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


class Union:
    def __init__(self):
        self.p = {}

    def find(self, x):
        while self.p.setdefault(x, x) != x:
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.p[max(a, b)] = min(a, b)


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines."""
    t = text or ""
    w = t.encode().split()
    lines = [x for x in t.split("\n") if x.encode().split()]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {i + j for p in at.values() if len(p) > 1 for i in p for j in range(3)}
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(covered), len(lines))


def common(a, b):
    """Length of the longest common subsequence, by the textbook table between equal ends."""
    n, ends = min(len(a), len(b)), 0
    while ends < n and a[ends] == b[ends]:
        ends += 1
    a, b = a[ends:], b[ends:]
    tail = 0
    while tail < min(len(a), len(b)) and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b, ends = a[:len(a) - tail], b[:len(b) - tail], ends + tail
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return ends + row[-1]


def shingles(text):
    w = (text or "").encode().split()
    return [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def near_classes(rows):
    """doc_id -> smallest doc_id of its class, for rows (doc_id, text)."""
    u, s = Union(), {i: shingles(t) for i, t in rows}
    ids = sorted(s)
    for i in ids:
        u.find(i)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = s[a], s[b]
            if x and y and min(len(x), len(y)) >= 0.8 * max(len(x), len(y)):
                top = sum((Counter(x) & Counter(y)).values())
                if top < 0.8 * (len(x) + len(y) - top):
                    continue
                k = common(x, y)
                if k >= 0.8 * (len(x) + len(y) - k):
                    u.join(a, b)
    return {i: u.find(i) for i in ids}


def removals(rows, window=50):
    """(doc_id, n_words, n_removed, sha of the kept words) of rows (doc_id, text)."""
    owner = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        if i is not None:
            for a in range(len(w) - window + 1):
                k = tuple(w[a:a + window])
                owner[k] = min(owner.get(k, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for a in range(len(w) - window + 1):
            if i is not None and owner[tuple(w[a:a + window])] < i:
                gone[a:a + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), sum(gone), sha(b" ".join(kept))))
    return out


def line_cuts(rows):
    """(doc_id, kept text) of rows (doc_id, text); doc_ids distinct."""
    u, first, where = Union(), {}, {}
    for i, t in rows:
        for p, x in enumerate((t or "").split("\n")):
            if x.encode().split():
                first[x] = min(first.get(x, (i, p)), (i, p))
    s = {x: {x[j:j + 5] for j in range(max(1, len(x) - 4))} for x in first}
    # similar sets share one of the rarest fifth of either's shingles, so other pairs need no look
    often, holders = Counter(g for x in s.values() for g in x), defaultdict(list)
    for b in sorted(s, key=lambda x: len(s[x])):
        rare = sorted(s[b], key=lambda g: (often[g], g))[:len(s[b]) - math.ceil(0.8 * len(s[b])) + 1]
        for a in {a for g in rare for a in holders[g]}:
            k = len(s[a] & s[b])
            if k >= 0.8 * (len(s[a]) + len(s[b]) - k):
                u.join(a, b)
        for g in rare:
            holders[g].append(b)
    for x, at in first.items():
        r = u.find(x)
        where[r] = min(where.get(r, at), at)
    return [(i, "\n".join(x for p, x in enumerate((t or "").split("\n"))
                          if not x.encode().split() or where[u.find(x)] == (i, p))) for i, t in rows]


def shards(rows, n, cell_rows):
    """(doc_id, size, checksum, shard, shard of one more, slot) of rows (doc_id, text), weights equal."""
    def draw(*parts):
        return int(hashlib.md5("|".join("" if p is None else str(p) for p in parts).encode()).hexdigest()[:13], 16)

    cells, by = max(1, math.ceil(len(rows) / (n * cell_rows))), defaultdict(list)
    for i, t in rows:
        b = (t or "").encode()
        won, more = (max(range(k), key=lambda s: (draw(i, s), -s)) for k in (n, n + 1))
        crc = zlib.crc32(b)
        by[won].append((draw(i, crc, "cell") % cells, i is not None, i or 0, crc, len(b) + 16, (i, len(b) + 16, crc, won, more)))
    return [(*r[-1], slot) for x in by.values() for slot, r in enumerate(sorted(x, key=lambda r: r[:5]))]


def poisson_copies(rows, seed=17, power=0.5):
    """doc_id -> copies, for rows (doc_id, text, source)."""
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").encode())
    weight = {s: n ** power for s, n in size.items() if n}
    total, all_ = sum(weight.values()), sum(size.values())
    out = {}
    for i, _, s in rows:
        rate = weight[s] / total * all_ / size[s] if size[s] else 0.0
        parts, n = max(1, math.ceil(rate / 16)), 0
        for k in range(1, parts + 1):
            u = int(hashlib.md5(f"{seed}|{k}|{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
            p = c = math.exp(-rate / parts)
            j = 0
            while c <= u and j < 64:
                j += 1
                p *= rate / parts / j
                c += p
            n += j
        out[i] = n
    return out


def top(rows, every=20, k=20):
    v = {i: [math.floor(64 * float(x)) for x in e] for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    out = []
    for q in v:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[i], strict=True)), i)
                          for i in v if i != q and len(v[i]) == len(v[q]))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return out


def turns(rows):
    """conv_id -> (n_turns, sha of the turns, loss characters, sha of the loss text), rows (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t, r or "", x or ""))
    out = {}
    for c, ts in by.items():
        ts.sort(key=lambda t: t[0])
        loss = "".join(x for _, r, x in ts if r == "assistant")
        out[c] = (len(ts), sha("".join(f"{r}\n{x}\n" for _, r, x in ts).encode()), len(loss), sha(loss.encode()))
    return out


WORDS = re.compile(r"\w+")


def kneser_ney(labelled, texts, discount=0.95, uniform=0.9):
    """word -> evidence for every word of ``texts``, from (toxic, text) rows, by the formulas written out."""
    def stem(w):
        return w[:5] + "*" if len(w) > 5 else w

    n, of_stem, members = Counter(), Counter(), Counter()
    for t in texts:
        n.update(set(WORDS.findall((t or "").lower())))
    for w, k in n.items():
        of_stem[stem(w)] += k
        members[stem(w)] += 1
    models = {}
    for toxic in (0, 1):
        before, before_stem = defaultdict(set), defaultdict(set)
        for y, t in labelled:
            words = WORDS.findall(t.lower())
            for v, w in zip(["", *words], words):
                if y == toxic:
                    before[w].add(v)
                    before_stem[stem(w)].add(v)
        models[toxic] = before, before_stem

    def p(before, key, back):
        total = sum(map(len, before.values()))
        return max(len(before.get(key, ())) - discount, 0) / total + discount * len(before) / total * back

    def word_p(toxic, w):
        before, before_stem = models[toxic]
        if w is None:  # a word neither class knows, without the shared part
            share = below = 1.0
        else:
            share = (1 - uniform) * of_stem[stem(w)] / sum(of_stem.values()) + uniform / len(of_stem)
            below = (1 - uniform) * n[w] / of_stem[stem(w)] + uniform / members[stem(w)]
        return p(before, w, p(before_stem, w and stem(w), share) * below)

    none = math.log(word_p(1, None) / word_p(0, None))
    return {w: max(math.log(word_p(1, w) / word_p(0, w)) - none, 0.0) for w in n}
