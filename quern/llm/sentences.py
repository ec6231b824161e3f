"""Sentence units by a linear-chain model over possible boundaries.

Every character is tagged boundary or inside. Only closing marks (with the quotation marks and brackets right
behind), spaces of Thai text and paragraph ends can be boundaries, so the chain runs over those characters;
all others are inside. A candidate is described by categories (kind of mark, word before, what follows,
quotation state, script). The weights of single categories, of pairs and of a few triples, and the chain's transitions,
are those of a conditional random field fitted by gradient ascent to the :func:`weak_labels` of a bounded sample of
documents, and for Thai to its punctuation-stripped text (places inside words against the places where a space was
taken out, told apart by the characters on both sides). No table of combinations is learned: combinations the sample
lacks are judged from their parts. Viterbi decoding runs over all documents of a batch side by side.

Abbreviations are learned too: words that nearly always bear a full stop, and behind it a figure or small letter, are
counted over all documents (:func:`learned_abbreviations`) and join the short seed lists below.

Chinese and Japanese text that bears no mark is not cut inside a paragraph here, as a heading would be; ``unmarked`` has
a model trained on punctuation-stripped text for it.

Defined cases: null, empty and blank texts have no units; a blank line and the text's end close a unit
whatever the model says; documents delivered twice give equal rows once; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import functools
import itertools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.chars import DIGIT, LETTER, MARK, SPACE, classes, codes, slices
from quern.llm.sampling import bounded_texts
from quern.runtime import broadcast_if_small, written

#: Documents the model is fitted on, at most; and the candidates taken from them.
TRAIN_DOCS, TRAIN_CHARS = 2_000, 2_000_000
#: Longer texts are cut like all others but not learned from.
LONG_CHARS = 20_000
#: When a word counts as an abbreviation: times seen, share of its full stops that end nothing, share of its uses with one.
LEAST_SEEN, INSIDE_SHARE, WITH_STOP = 20, 0.9, 0.95
#: A few sentences that show each kind of mark, for tables whose sample lacks it.
LESSONS = [
    "It rained. The road was wet! Was it closed? \u201cNo.\u201d She left... Then it cleared. See fig. 3 and p. 7. Mr. Hale came at 5.30 p.m. and left. 1. First point.\n2. Second point.\nThe file is a.txt. It costs 3.50 today.",
    "\u201cWait!\u201d he said. \u201cIs it far?\u201d asked Ana. (It was not.) J. R. Marsh wrote it, etc. The rest is lost.",
    "旧灯塔在河边。他问：“远吗？”她笑了！真的吗？然后他走了。", "灯台は古い。「遠い？」と彼は聞いた。そうだ！", "दीप पुराना है। क्या वह दूर है? हाँ!", "المنارة قديمة. هل هي بعيدة؟ نعم!", "Маяк стар. Он далёк? Да! См. рис. 3 и т. д.",
]

OTHER, BLANK, LINE, UPPER, LOWER, LETTER_, DIGIT_, JOIN, STOP, DOTS, ASK, FULL, OPEN, CLOSE, PAREN, PAREN_END, HIGH, STRAIGHT, DASH, COMMA, COLON, APOS, LEAD = range(23)

#: Words before a full stop that never end a sentence, and those that may.
TITLES = """dr dra sr sra srta eng ing prof profa mr mrs ms st capt gen col av art fig figs cap cf vgl véase ch chap sec abb nr
núm vol pág pp ex ej es al dott dott.ssa ssa sig sigg arq lic см рис табл ул проф стр гл им г-н fr frl hr bd kap tab eq vs www
डॉ श्री प्रो पं""".split()
MAY_END = "etc usw ecc h m др пр тыс руб д п г".split()
MONTHS = "januar februar märz april mai juni juli august september oktober november dezember".split()


@functools.lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    base = classes()
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    out[base == LETTER] = LETTER_
    out[base == DIGIT] = DIGIT_
    out[base == MARK] = JOIN
    out[(base == SPACE)] = BLANK
    out[10] = LINE
    for c in (*range(0x41, 0x590), *range(0x10A0, 0x1100), *range(0x1E00, 0x2000), *range(0x2C00, 0x2E00)):
        ch = chr(c)
        if ch.isalpha():
            out[c] = LOWER if ch.islower() else UPPER if ch != ch.lower() else LETTER_
    for kind, chars in ((STOP, ".．"), (DOTS, "…"), (ASK, "!?！？؟"), (FULL, "。｡।॥۔"), (OPEN, "„«「『《‹‟〈"), (CLOSE, "”»」』》›〉"), (PAREN, "([{（【"), (PAREN_END, ")]}）】"), (HIGH, "“"), (STRAIGHT, '"'), (DASH, "—–-"), (COMMA, ",;،؛、，；"), (COLON, ":："), (APOS, "’'"), (LEAD, "¿¡")):
        for ch in chars:
            out[ord(ch)] = kind
    return out


@functools.lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    out = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in range(0x41, 0x2E00):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


_P = np.uint64(1_000_003)


def _hash(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        h = 0
        for ch in w:
            h = (h * 1_000_003 + ord(ch)) % (1 << 64)
        out.append(h)
    return np.array(sorted(out), np.uint64)


@functools.lru_cache(maxsize=1)
def _word_lists() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _hash(TITLES), _hash(MAY_END), _hash(MONTHS)


def _among(h: np.ndarray, listed: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(listed, h), len(listed) - 1)
    return listed[at] == h


# Category values. Mark kinds: full stop, dots, question or exclamation, full-width stop, Thai space, Thai inside.
K_STOP, K_DOTS, K_ASK, K_FULL, K_THAI, K_NONE = range(6)
P_WORD, P_TITLE, P_MAY, P_INITIAL, P_SINGLE, P_SHORT, P_NUMBER, P_OTHER, P_LIST, P_ORDINAL = range(10)
N_DU, N_DL, N_DD, N_DC, N_DS, N_DP, N_SU, N_SL, N_SD, N_SC, N_SO, N_SS, N_SP, N_SH = range(14)
Q_NONE, Q_INSIDE, Q_COLON, Q_CLOSED = range(4)
SHAPE = (6, 10, 14, 4, 3, 5)


class Candidates:
    """Possible boundaries of many texts: ``doc``, ``end`` (position in the text) and categories ``cat``;
    ``forced``: (doc, end) of paragraph ends."""

    def __init__(self, texts: list[str], inside: bool = False, abbreviations: np.ndarray | None = None):
        border = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])])
        c = codes("\n\n".join(texts) + "\n\n")
        kind = kinds()[c]
        ns = np.nonzero((kind != BLANK) & (kind != LINE))[0]
        self.doc = self.end = np.zeros(0, np.int64)
        self.cat = np.zeros((0, len(SHAPE)), np.int64)
        self.pair = np.zeros(0, np.int64)
        self.forced = (self.doc, self.end)
        n = len(ns)
        if not n:
            return
        lines = np.cumsum(kind == LINE)
        newlines = np.diff(lines[ns], prepend=lines[ns[0]] - 2)
        gap = np.diff(ns, prepend=-2) > 1
        gap[0] = True
        para = np.cumsum(newlines >= 2)
        k, ch = kind[ns], c[ns]
        doc_of = lambda at: np.searchsorted(border, at, "right") - 1
        last = np.nonzero(np.append(para[1:] != para[:-1], True))[0]
        fd = doc_of(ns[last])
        self.forced = (fd, ns[last] + 1 - border[fd])

        # Quotation depth within each paragraph.
        rise = np.zeros(n, np.int32)
        quote = np.nonzero((k == OPEN) | (k == CLOSE) | (k == HIGH) | (k == STRAIGHT))[0]
        kq, cq, pq = k[quote], ch[quote], para[quote]
        up = (kq == OPEN) | (kq == HIGH)
        before_low = np.concatenate([[False], (cq[:-1] == 0x201E) & (pq[:-1] == pq[1:])]) if len(quote) else np.zeros(0, bool)
        up &= ~((kq == HIGH) & before_low)
        straight = np.nonzero(kq == STRAIGHT)[0]
        if len(straight):
            first = np.concatenate([[True], pq[straight][1:] != pq[straight][:-1]])
            start = np.maximum.accumulate(np.where(first, np.arange(len(straight)), 0))
            up[straight] = (np.arange(len(straight)) - start) % 2 == 0
        rise[quote] = np.where(up, 1, -1)
        deep = np.cumsum(rise)
        low = np.minimum(deep, deep - rise).astype(np.int64) - para * (1 << 24)
        depth = deep - (np.minimum.accumulate(low) + para * (1 << 24))
        opened = np.zeros(n, np.int64)
        opened[quote[up]] = quote[up]
        opened = np.maximum.accumulate(opened)
        closing = (k == CLOSE) | ((rise < 0) & ((k == HIGH) | (k == STRAIGHT)))

        mark = (k >= STOP) & (k <= FULL)
        begin = np.nonzero(mark & ~(np.concatenate([[False], mark[:-1]]) & ~gap))[0]
        follows = np.append(mark[1:] & ~gap[1:], False)
        stop_at = np.nonzero(mark & ~follows)[0]
        cur = stop_at + 1
        pad = lambda x, v: np.append(x, v)
        kp, gp, cp, pp = pad(k, OTHER), pad(gap, True), pad(ch, 0), pad(para, -1)
        closing_p, after_close = pad(closing, False), np.zeros(len(cur), bool)
        paren = np.zeros(len(cur), bool)
        for _ in range(4):
            right = (closing_p[cur] | (kp[cur] == PAREN_END) | (kp[cur] == APOS)) & (pp[cur] == para[stop_at]) & (~gp[cur] | (cp[cur] == 0xBB))
            after_close |= right & closing_p[cur]
            paren |= right & (kp[cur] == PAREN_END)
            cur = np.minimum(cur + right, n)
        inner = pp[cur] == para[stop_at]  # otherwise the paragraph ends here: forced
        begin, stop_at, cur, after_close, paren = begin[inner], stop_at[inner], cur[inner], after_close[inner], paren[inner]

        counts = np.cumsum(k == ASK)
        full = np.cumsum(k == FULL)
        some = lambda total, kk: total[stop_at] - total[begin] + (k[begin] == kk) > 0
        mk = np.where(some(counts, ASK), K_ASK, np.where(some(full, FULL), K_FULL, np.where((k[begin] == DOTS) | (stop_at > begin), K_DOTS, K_STOP)))

        # The word right before the mark.
        word = (k == UPPER) | (k == LOWER) | (k == LETTER_) | (k == DIGIT_) | (k == JOIN)
        starts_word = word & (gap | ~np.concatenate([[False], word[:-1]]))
        wstart = np.maximum.accumulate(np.where(starts_word, np.arange(n), 0))
        prev = np.maximum(begin - 1, 0)
        has = (begin > 0) & word[prev] & ~gap[begin] & (para[prev] == para[begin])
        w0 = np.where(has, wstart[prev], prev)
        size = np.where(has, begin - w0, 0)
        digits = np.cumsum(k == DIGIT_)
        all_digits = has & (digits[prev] - digits[w0] + (k[w0] == DIGIT_) == size)
        h = np.zeros(len(begin), np.uint64)
        low_ch = _lower()[ch]
        for j in range(6):
            h = np.where(size > j, h * _P + low_ch[np.minimum(w0 + j, n - 1)], h)
        titles, may, months = _word_lists()
        titles = titles if abbreviations is None else abbreviations
        short = has & (size <= 6)
        behind = np.maximum(w0 - 1, 0)
        line_start = gap[w0] & ((newlines[w0] >= 2) | ((newlines[w0] == 1) & np.isin(k[behind], (STOP, DOTS, ASK, FULL, COLON))))
        list_start = line_start | ((w0 > 0) & ((k[behind] == COMMA) | (k[behind] == COLON)) & (ch[behind] != 0x2C))
        nxt_h = np.zeros(len(begin), np.uint64)
        nxt_end = np.zeros(len(begin), bool)
        for j in range(10):
            at = np.minimum(cur + j, n - 1)
            nxt_end |= (cur + j >= n) | ~word[at] | ((j > 0) & gap[at])
            nxt_h = np.where(nxt_end, nxt_h, nxt_h * _P + low_ch[at])
        pv = np.full(len(begin), P_OTHER)
        pv[has] = P_WORD
        pv[all_digits] = P_NUMBER
        pv[all_digits & (size <= 2)] = P_SHORT
        pv[all_digits & (size <= 2) & _among(nxt_h, months)] = P_ORDINAL
        pv[all_digits & (size <= 2) & list_start] = P_LIST
        one = has & (size == 1) & ~all_digits
        pv[one & (k[w0] == UPPER)] = P_INITIAL
        pv[one & (k[w0] == LOWER)] = P_SINGLE
        pv[one & (k[w0] == LETTER_) & (ch[w0] < 0x2E80)] = P_TITLE
        pv[one & (k[w0] == UPPER) & (ch[w0] == 0x4D)] = P_TITLE
        pv[short & _among(h, titles) & (pv != P_INITIAL)] = P_TITLE
        pv[short & _among(h, may) & ~np.isin(pv, (P_INITIAL, P_TITLE))] = P_MAY

        # What follows the mark and its closers.
        kn, gn = k[cur], gap[cur]
        nx = np.full(len(begin), N_DS)
        for kinds_, direct, spaced in (((UPPER,), N_DU, N_SU), ((LOWER,), N_DL, N_SL), ((DIGIT_,), N_DD, N_SD), ((LETTER_,), N_DC, N_SC), ((OPEN, HIGH, STRAIGHT, PAREN, LEAD, APOS), N_SO, N_SO), ((DASH,), N_DP, N_SH), ((OTHER, JOIN), N_DS, N_SS), ((COMMA, COLON, STOP, DOTS, ASK, FULL, CLOSE, PAREN_END), N_DP, N_SP)):
            hit = np.isin(kn, kinds_)
            nx[hit] = np.where(gn[hit], spaced, direct)
        left = np.where(depth[cur - 1] > 0, Q_INSIDE, np.where(after_close, Q_CLOSED, Q_NONE))
        opener = opened[cur - 1]
        after_colon = (opener > 0) & (k[np.maximum(opener - 1, 0)] == COLON)
        left[(left == Q_CLOSED) & after_colon] = Q_COLON
        shut = np.where(after_close, 2, np.where(paren, 1, 0))
        script = np.where(ch[prev] < 0x590, 0, np.where(ch[prev] < 0x900, 1, np.where(ch[prev] < 0xE00, 2, np.where(ch[prev] < 0xE80, 3, 4))))
        cat = np.stack([mk, pv, nx, left, shut, script], 1)
        end = ns[cur - 1] + 1

        # Thai: spaces inside paragraphs written mostly in it.
        thai = (ch >= 0xE00) & (ch < 0xE80)
        if thai.any():
            own = np.bincount(para, thai, para[-1] + 1)
            all_of = np.bincount(para, word, para[-1] + 1)
            mostly = (2 * own > all_of)[para]
            after = np.concatenate([[False], (thai | (k == DIGIT_) | closing | (k == PAREN_END))[:-1]])
            same = np.concatenate([[False], para[1:] == para[:-1]])
            sp = np.nonzero(mostly & gap & same & (newlines == 0) & thai & after)[0]
            self._thai = (sp, ch)
            pair = lambda at: 1 + (ch[at - 1].astype(np.int64) * 131 + ch[at]) % 4093
            rows = np.zeros((len(sp), len(SHAPE)), np.int64)
            rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 5] = K_THAI, P_OTHER, N_SC, 3
            more_end, more_pair = ns[sp - 1] + 1, pair(sp)
            if inside:
                within = np.nonzero(mostly & ~gap & thai & after)[0][::7]
                extra = rows[:1].repeat(len(within), 0) if len(rows) else np.zeros((0, len(SHAPE)), np.int64)
                within = within[: len(extra)]
                extra[:, 0] = K_NONE
                rows = np.concatenate([rows, extra])
                more_end, more_pair = np.concatenate([more_end, ns[within - 1] + 1]), np.concatenate([more_pair, pair(within)])
            cat = np.concatenate([cat, rows])
            self.pair = np.concatenate([np.zeros(len(end), np.int64), more_pair])
            end = np.concatenate([end, more_end])
        else:
            self.pair = np.zeros(len(end), np.int64)
        order = np.argsort(end, kind="stable")
        self.cat, self.pair, end = cat[order], self.pair[order], end[order]
        self.doc = doc_of(end - 1)
        self.end = end - border[self.doc]


def weak_labels(cat: np.ndarray) -> np.ndarray:
    """Labelling function: 1 where a boundary is to be expected from the categories."""
    mk, pv, nx, q, shut, _ = cat.T
    isin = np.isin
    fresh = isin(nx, (N_SU, N_SO, N_SD, N_SC, N_SS, N_SH, N_DU, N_DC))
    dash_quote = (nx == N_SH) & (q >= Q_COLON)
    stop = fresh & ~isin(pv, (P_TITLE, P_INITIAL, P_SINGLE, P_LIST, P_ORDINAL)) & ~((pv == P_MAY) & isin(nx, (N_SD, N_DC)))
    dots = isin(nx, (N_SU, N_SO, N_SD, N_SC, N_SS, N_SH, N_DU))
    full = ~((q == Q_CLOSED) & isin(nx, (N_DC, N_DP))) & ~((q >= Q_COLON) & (nx == N_DP))
    ask = fresh & ~((q == Q_CLOSED) & (nx == N_DC))
    y = np.where(mk == K_STOP, stop, np.where(mk == K_DOTS, dots, np.where(mk == K_ASK, ask, np.where(mk == K_FULL, full, mk == K_THAI))))
    return (y & (q != Q_INSIDE) & ~dash_quote).astype(np.int64)


#: Categories that count together, beside each by itself.
TOGETHER = [*itertools.combinations(range(len(SHAPE)), 2), (0, 1, 2), (0, 2, 3), (0, 3, 4)]


def _columns(cat: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Feature numbers of each candidate: single categories, those of :data:`TOGETHER`, Thai pair."""
    cols, base = [], 0
    for group in [*((j,) for j in range(len(SHAPE))), *TOGETHER]:
        shape = tuple(SHAPE[j] for j in group)
        cols.append(base + np.ravel_multi_index(tuple(cat[:, j] for j in group), shape))
        base += int(np.prod(shape))
    cols.append(base + pair)
    return np.stack(cols, 1)


N_FEATURES = sum(SHAPE) + sum(int(np.prod([SHAPE[j] for j in group])) for group in TOGETHER) + 4096


class Chain:
    """Two-tag linear-chain conditional random field with sparse categorical features."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None, abbreviations: np.ndarray | None = None):
        self.weights = np.zeros(N_FEATURES) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves
        self.abbreviations = abbreviations if abbreviations is not None and len(abbreviations) else _word_lists()[0]

    @staticmethod
    def _grid(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        new = np.concatenate([[True], doc[1:] != doc[:-1]])
        row = np.cumsum(new) - 1
        col = np.arange(len(doc)) - np.nonzero(new)[0][row]
        return row, col, int(row[-1]) + 1

    def fit(self, cols: np.ndarray, doc: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 1.0, decay: float = 1e-4) -> Chain:
        """Adaptive gradient ascent on the conditional likelihood (forward-backward over the grid)."""
        row, col, rows = self._grid(doc)
        width = int(col.max()) + 1
        sums = np.full(N_FEATURES, 1e-8)
        move_sums = np.full((2, 2), 1e-8)
        follow = np.nonzero(col > 0)[0]
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[follow - 1], y[follow]), 1)
        by_col = np.argsort(col, kind="stable")
        edges = np.searchsorted(col[by_col], np.arange(width + 1))
        for _ in range(rounds):
            score = np.stack([np.zeros(len(cols)), self.weights[cols].sum(1)], 1)
            fwd, bwd = np.zeros((len(cols), 2)), np.zeros((len(cols), 2))
            for t in range(width):
                at = by_col[edges[t] : edges[t + 1]]
                fwd[at] = score[at] if t == 0 else score[at] + np.logaddexp(fwd[at - 1, :1] + self.moves[0], fwd[at - 1, 1:] + self.moves[1])
            for t in range(width - 1, 0, -1):
                at = by_col[edges[t] : edges[t + 1]]
                ahead = (score[at] + bwd[at])[:, None, :] + self.moves[None]
                bwd[at - 1] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
            both = fwd + bwd
            total = np.logaddexp(both[:, 0], both[:, 1])
            p = np.exp(both[:, 1] - total)
            grad = np.bincount(cols.ravel(), np.repeat(y - p, cols.shape[1]), N_FEATURES) - decay * self.weights
            sums += grad * grad
            self.weights = self.weights + rate * grad / np.sqrt(sums)
            pair = fwd[follow - 1][:, :, None] + self.moves[None] + (score[follow] + bwd[follow])[:, None, :] - total[follow][:, None, None]
            move_grad = seen - np.exp(pair).sum(0) - decay * self.moves
            move_sums += move_grad * move_grad
            self.moves = self.moves + 0.1 * rate * move_grad / np.sqrt(move_sums)
        return self

    def decode(self, cols: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Viterbi path of every document, all documents side by side."""
        if not len(doc):
            return np.zeros(0, np.int64)
        row, col, rows = self._grid(doc)
        order = np.argsort(col, kind="stable")
        edges = np.searchsorted(col[order], np.arange(int(col.max()) + 2))
        best = np.stack([np.zeros(len(cols)), self.weights[cols].sum(1)], 1)
        back = np.zeros((len(cols), 2), np.int8)
        for t in range(1, len(edges) - 1):
            at = order[edges[t] : edges[t + 1]]
            ways = best[at - 1][:, :, None] + self.moves[None]
            back[at] = ways.argmax(1)
            best[at] += ways.max(1)
        tag = np.zeros(len(cols), np.int64)
        final = np.append(doc[1:] != doc[:-1], True)
        tag[final] = best[final].argmax(1)
        for t in range(len(edges) - 2, 0, -1):
            at = order[edges[t] : edges[t + 1]]
            tag[at - 1] = back[at, tag[at]]
        return tag


def fit(texts: list[str], abbreviations: np.ndarray | None = None) -> Chain:
    """The chain fitted on the weak labels of a bounded sample."""
    chain = Chain(abbreviations=abbreviations)
    cats, pairs, docs, first = [np.zeros((0, len(SHAPE)), np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for _, run in slices([*texts, *LESSONS]):
        found = Candidates(run, True, chain.abbreviations)
        cats.append(found.cat)
        pairs.append(found.pair)
        docs.append(found.doc + first)
        first += len(run)
    cat, pair, doc = np.concatenate(cats), np.concatenate(pairs), np.concatenate(docs)
    return chain.fit(_columns(cat, pair), doc, weak_labels(cat))


def learned_abbreviations(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Hashes of the seed titles and of the words of up to six letters that the whole table shows to be abbreviations:
    at least :data:`LEAST_SEEN` times before a full stop that a figure, small letter or pause follows, in at least
    :data:`INSIDE_SHARE` of the full stops behind them, and hardly ever without one. Counted with partial sums a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for _, run in slices(batch.column(0).to_pylist()):
                held.append(stop_counts(run))
            held = [_summed(held)]
        if held:
            total = held[0]
            yield pa.RecordBatch.from_arrays([pa.array(total[:, j].view(np.int64)) for j in range(4)], names=["word", "inside", "other", "bare"])

    rows = df.where(F.length(text_col) > 0).select(text_col).mapInArrow(count, "word long, inside long, other long, bare long")
    sums = rows.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("inside", "other", "bare")])
    stops = F.col("inside") + F.col("other")
    found = sums.where((F.col("inside") >= LEAST_SEEN) & (F.col("inside") >= INSIDE_SHARE * stops) & (stops >= WITH_STOP * (stops + F.col("bare"))))
    own = np.array([r["word"] for r in found.select("word").collect()], np.int64).view(np.uint64)
    return np.unique(np.concatenate([_word_lists()[0], own]))


def _summed(parts: list[np.ndarray]) -> np.ndarray:
    every = np.concatenate(parts)
    word, at = np.unique(every[:, 0], return_inverse=True)
    return np.stack([word, *(np.bincount(at, every[:, j].astype(np.float64), len(word)).astype(np.uint64) for j in (1, 2, 3))], 1)


def stop_counts(texts: list[str]) -> np.ndarray:
    """(word hash, full stops with the sentence going on, other full stops, no full stop) of the words of up to six letters."""
    c = codes("\n\n".join(texts) + "\n\n\n")
    kind = kinds()[c]
    letter = (kind == UPPER) | (kind == LOWER) | (kind == LETTER_) | (kind == JOIN)
    edge = np.diff(np.concatenate([[False], letter, [False]]).astype(np.int8))
    start, end = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    keep = (end - start <= 6) & (end - start > 1) & (kind[np.maximum(start - 1, 0)] != DIGIT_) & (end + 2 < len(c))
    start, end = start[keep], end[keep]
    low = _lower()[c]
    h = np.zeros(len(start), np.uint64)
    for j in range(6):
        h = np.where(end - start > j, h * _P + low[np.minimum(start + j, len(c) - 1)], h)
    stop = (c[end] == 0x2E) & (kind[end + 1] == BLANK)
    inside = stop & np.isin(kind[end + 2], (DIGIT_, LOWER)) | (c[end] == 0x2E) & (kind[end + 1] == COMMA)
    other = (c[end] == 0x2E) & ~inside
    rows = np.stack([h, inside.astype(np.uint64), other.astype(np.uint64), (c[end] != 0x2E).astype(np.uint64)], 1)
    return _summed([rows])


def unit_ends(texts: list[str], model: Chain) -> tuple[np.ndarray, np.ndarray]:
    """(index of text, end) of every sentence unit, in order."""
    found = Candidates(texts, abbreviations=model.abbreviations)
    yes = model.decode(_columns(found.cat, found.pair), found.doc) == 1
    doc = np.concatenate([found.doc[yes], found.forced[0]])
    end = np.concatenate([found.end[yes], found.forced[1]])
    both = np.unique(doc.astype(np.int64) * (1 << 40) + end)
    return both >> 40, both & ((1 << 40) - 1)


def training_sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> list[str]:
    """At most ``rows`` texts and ``chars`` characters, none over :data:`LONG_CHARS`: those with the smallest hash of their id."""
    return [r[text_col] for r in bounded_texts(df, id_col, text_col, rows=rows, chars=chars, longest=LONG_CHARS)]


def sentence_units(df: DataFrame, model: Chain | None = None) -> DataFrame:
    """(doc_id, sent_end) of every sentence unit of every document."""
    chain = model or fit(training_sample(df), learned_abbreviations(df))
    shared = df.sparkSession.sparkContext.broadcast((chain.weights, chain.moves, chain.abbreviations))
    schema = T.StructType([df.schema["doc_id"], T.StructField("sent_end", T.IntegerType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Chain(*shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            at, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for first, run in slices(texts):
                d, e = unit_ends(run, own)
                at.append(d + first)
                ends.append(e)
            ids = batch.column(0).take(pa.array(np.concatenate(at)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(ends).astype(np.int32))], names=["doc_id", "sent_end"])

    rows = df.select("doc_id", "text").where("doc_id is not null and text is not null and text <> ''")
    twice = broadcast_if_small(written(df.groupBy("doc_id").count().where("doc_id is not null and count > 1").select("doc_id"), "twice"))
    # Only documents delivered twice are shuffled; all others are cut where they are read.
    once = rows.join(twice, "doc_id", "left_anti").mapInArrow(cut, schema)
    return once.unionByName(rows.join(twice, "doc_id", "left_semi").mapInArrow(cut, schema).distinct())
