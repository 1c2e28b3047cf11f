"""Plain Python versions of the operators' contracts, for small inputs."""
import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        taken = False
        for i in ids:
            out.append((i, keep, len(ids), i == keep and not taken, sha(text)))
            taken = taken or i == keep
    return out


def substrings(rows, length=35):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(x[k:k + length]) for _, x in texts for k in range(len(x) - length + 1))
    out = []
    for i, x in texts:
        gone = [False] * len(x)
        for k in range(len(x) - length + 1):
            if seen[tuple(x[k:k + length])] > 1:
                gone[k:k + length] = [True] * length
        out.append((i, len(x), sum(gone), sha(" ".join(a for a, g in zip(x, gone) if not g))))
    return out


def shingles(text, size=5):
    x = WORD.findall(folded(text))
    return frozenset(tuple(x[k:k + size]) for k in range(len(x) - size + 1)) if len(x) >= size else frozenset([tuple(x)] if x else [])


def near(rows, percent, size=5):
    sets = [(i, shingles(t, size)) for i, t in rows]
    up = list(range(len(sets)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a
    for a in range(len(sets)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            n = len(s & t)
            if n and 100 * n >= percent * len(s | t):
                up[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        ids[root(k)].append(i)
    out = []
    for k, (i, s) in enumerate(sets):
        known = [x for x in ids[root(k)] if x is not None]
        first = (min(known) if known else None) if s else i
        out.append((i, len(s), first, i == first))
    return out


def contamination(rows, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        x = ALNUM.findall(folded(text))
        if 0 < len(x) < window:
            windows[tuple(x)].add(item)
        for k in range(len(x) - window + 1):
            windows[tuple(x[k:k + window])].add(item)
    lengths = {len(k) for k in windows}
    out = []
    for i, t in rows:
        x = ALNUM.findall(folded(t))
        hit, found = [False] * len(x), set()
        for n in lengths:
            for k in range(len(x) - n + 1):
                key = tuple(x[k:k + n])
                if key in windows:
                    found |= windows[key]
                    hit[k:k + n] = [True] * n
        names = ",".join(sorted("" if f is None else str(f) for f in found))
        out.append((i, len(x), sum(hit), len(found), sha(names), sum(hit) > 0 and 20 * sum(hit) >= len(x)))
    return out


def earlier(rows, length=50):
    last = float("inf")
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, x in texts:
        rank = last if i is None else i
        for k in range(len(x) - length + 1):
            key = x[k:k + length]
            first[key] = min(first.get(key, last), rank)
    out = []
    for i, x in texts:
        rank, gone = last if i is None else i, [False] * len(x)
        for k in range(len(x) - length + 1):
            if first[x[k:k + length]] < rank:
                gone[k:k + length] = [True] * length
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(x), sum(gone), runs, sha(bytes(c for c, g in zip(x, gone) if not g))))
    return out


def held(i, folds=10):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == 0


def scores(rows, strengths=(100.0, 2.0)):
    texts = [(i, WORD.findall(folded(t)) + ["\n"]) for i, t in rows]
    one, two, three, starts = Counter(), Counter(), Counter(), 0
    for i, x in texts:
        if not held(i):
            starts += 1
            y = ["^\n", *x]
            one.update(x)
            two.update(zip(y, y[1:]))
            three.update(zip(y, y[1:], y[2:]))
    n, v = sum(one.values()), len(one)
    out = []
    for i, x in texts:
        y, base, score = ["^\n", *x], 0.0, 0.0
        for k, a in enumerate(x):
            p = (one[a] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            total = starts if y[k] == "^\n" else one[y[k]]
            p = (two[y[k], a] + strengths[0] * p) / (total + strengths[0])
            if k:  # a context that training does not have gives p as it is
                p = (three[y[k - 1], y[k], a] + strengths[1] * p) / (two[y[k - 1], y[k]] + strengths[1])
            score += math.log10(p)
        out.append((i, held(i), len(x), sum(one[a] > 0 for a in x), n, base, score))
    return out


def mix(rows, cap=3):
    sized = [(i, s, len(WORD.findall(t or "")), hashlib.md5((f"mix:{i}" if i is not None else "mix").encode()).hexdigest()) for i, t, s in rows]
    sources = sorted({s for _, s, _, _ in sized if s is not None}, key=lambda s: s.encode()) + ([None] if any(s is None for _, s, _, _ in sized) else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(sources)}
    size = {s: sum(z for _, t, z, _ in sized if t == s) for s in sources}
    total, target, open_ = sum(size.values()), {}, set(sources)
    while True:
        left = total - sum(target.values())
        over = [s for s in open_ if weight[s] * left / sum(weight[t] for t in open_) > cap * size[s]]
        if not over:
            break
        for s in over:
            target[s] = float(cap * size[s])
        open_ -= set(over)
    left = total - sum(target.values())
    for s in open_:
        target[s] = weight[s] * left / sum(weight[t] for t in open_)
    return sized, size, target


def audit(rows, labels):
    """``rows``: id, text, part. Every order run step by step over the documents."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    docs = []
    for i, t, part in rows:
        text = t or ""
        x = WORD.findall(text)
        fails = {f for f, bad in zip("ABCDE", (
            len(x) < 200, 100 * len(set(x)) < 50 * len(x), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            any(c in "#$%&*|" for c in text), i is not None and i > first[text])) if bad}
        mine = [(q, x) for j, q, x in labels if i is not None and j == i]
        docs.append((part or "", fails, any(q == 1 for q, _ in mine), any(x == 1 for _, x in mine)))
    out, share = [], Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                failed = sum(f in d[1] for d in own)
                share[part, f] += len(gone)
                out.append((part, "".join(order), step, len(left), len(gone), failed - len(gone), sum(d[1] == {f} for d in own),
                            sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return [(*r, share[r[0], r[1][r[2] - 1]]) for r in out]


def top_k(rows, k=5, every=50):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, limit = [], (1 << 63) - 1
    for at, (i, v) in enumerate(usable):
        if i is not None and i % every == 0:
            others = [(-max(-limit, min(limit, sum(a * c for a, c in zip(v, x)))), j is None, j) for n, (j, x) in enumerate(usable) if n != at]
            out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(sorted(others, key=lambda o: (o[0], o[1], o[2] or 0))[:k], 1)]
    return out


def alignment(rows, a_path, b_path):
    """Whole texts encoded one by one; a group ends where tokens of both end."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path)
    a.encode_special_tokens = True
    printable = [x for x in range(256) if 0x21 <= x <= 0x7E or 0xA1 <= x <= 0xAC or x >= 0xAE]
    letters = {chr(x): x for x in printable} | {chr(0x100 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()
    docs, holders = [], Counter()
    for i, t in rows:
        text = t or ""
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw_a, raw_b = [bytes(letters[c] for c in a.id_to_token(x)) for x in ids_a], [b_bytes(x) for x in ids_b]
        if b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            ids_a, ids_b, raw_a, raw_b = [], [], [], []
        ends_a, ends_b = list(itertools.accumulate(map(len, raw_a))), list(itertools.accumulate(map(len, raw_b)))
        groups, x, y = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            u, v = ends_a.index(cut, x) + 1, ends_b.index(cut, y) + 1
            groups.append((ids_a[x:u], ids_b[y:v]))
            x, y = u, v
        links = Counter((p, q) for g, h in groups for p in g for q in h)
        holders.update(links.keys())
        docs.append((i, ids_a, ids_b, groups, links))
    most = Counter()
    for (p, _), n in holders.items():
        most[p] = max(most[p], n)
    out = []
    for i, ids_a, ids_b, groups, links in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((i, len(ids_a), len(ids_b), len(groups), sum(links.values()), sum(n for (p, q), n in links.items() if holders[p, q] == most[p]),
                    sum(n * holders[k] for k, n in links.items()), sha(text) if groups else ""))
    return out


def tokens(rows, scores, unknown, space="▁"):
    """Every word by itself: the best cut of each of its prefixes, over all pieces."""
    counted = {}

    def count(word):
        best = [(0.0, 0)]
        for end in range(1, len(word) + 1):
            options = [(best[k][0] + scores[word[k:end]], -best[k][1] - 1) for k in range(end) if word[k:end] in scores]
            if word[end - 1] not in scores:
                options.append((best[end - 1][0] + unknown, -best[end - 1][1] - len(word[end - 1].encode())))
            total, n = max(options)
            best.append((total, -n))
        return best[-1][1]
    out = []
    for i, t in rows:
        words = WORD.findall(t or "")
        for x in words:
            if x not in counted:
                counted[x] = count(space + x)
        out.append((i, len(words), sum(counted[x] for x in words)))
    return out
