"""Markup residue in text: a linear-chain CRF over the leaf blocks of a tolerant DOM.

A text is parsed into leaves (lines and parts of lines between block tags) that carry
their ancestors: HTML elements, LaTeX environments and wiki tags. Each leaf has features
of its ancestors and of the characters around its marks; the CRF labels the sequence by Viterbi
with the kind of block and whether it bears markup. Labels give both the finding (which fields hold
markup) and the clean text, in which headings, lists, code and formulas are kept.
"""

from __future__ import annotations

import html
import random
import zlib
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.linear import sample

#: Kinds of leaf; a "+" marks that it bears markup.
LABELS = ("text", "text+", "head+", "item", "item+", "code", "code+", "formula", "formula+", "table+", "quote+", "drop+")
MARKED = tuple(x.endswith("+") for x in LABELS)
SPACE_LOG2 = 15
MASK_FORMULA, MASK_CODE = "\x01", "\x02"

BLOCK_TAGS = frozenset("p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre table thead tbody tr td th blockquote br hr section article header footer figure figcaption center math syntaxhighlight source nowiki".split())
VOID_TAGS = frozenset("br hr img input meta link wbr".split())

TAG = regex.compile(r"<!--.*?(?:-->|\Z)|</?[A-Za-z][A-Za-z0-9]*(?:\s+[A-Za-z_:][\w:.-]*(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'=<>`]+))?)*\s*/?>|\\(?:begin|end)\{[A-Za-z]+\*?\}|\n", regex.DOTALL)
PROTECTED = regex.compile(r"(?P<code>```[ \t]*(?:python|py)[ \t]*\n.*?(?:```|\Z))|(?P<other>```.*?(?:```|\Z))|(?P<formula>\$\$.*?(?:\$\$|\Z)|\\\[.*?(?:\\\]|\Z)|\$[^$\n]*(?:\$|(?=\n)|\Z))", regex.DOTALL | regex.IGNORECASE)

#: Marks that markup and plain text both hold; what they mean is for the chain to say.
RUN = regex.compile(r"://|[<>&*_~`#=\[\]|{}\\^+!@-]+|'{2,}")
ANY_MARK = regex.compile(r"://|[<>&*_~`#=\[\]|{}\\^+!@-]|''")
SHAPE = regex.compile(r"(\x01+)|(\x02+)|(\p{L}[\p{L}\p{M}]*(?:['’]\p{L}+)*)|(\d+(?:[.,]\d+)*)|(\s+)")
#: Texts of these characters alone bear no markup: pages are made from them.
BARE = regex.compile(r"[\p{L}\p{M}\d\s\x01\x02.,;:!?()'’\"“”„«»%/–—…-]*")


@dataclass
class Leaf:
    raw: str
    masked: str
    path: tuple[str, ...]
    hints: list[str] = field(default_factory=list)
    gap: bool = False


def parse(text: str) -> list[Leaf]:
    """Leaves of a text in order; whitespace alone makes none, structure without text one each."""
    masked = list(text)
    for m in PROTECTED.finditer(text):
        if m["other"] is None:
            masked[m.start() : m.end()] = (MASK_CODE if m["code"] else MASK_FORMULA) * (m.end() - m.start())
    hidden = "".join(masked)
    leaves: list[Leaf] = []
    stack: list[str] = []
    raw: list[str] = []
    plain: list[str] = []
    hints: list[str] = []
    fenced = gap = False

    def close(newline: bool = False) -> None:
        nonlocal raw, plain, hints, gap
        a, b = "".join(raw), "".join(plain)
        if b.strip() or any(h.startswith(("comment", "void", "env")) for h in hints):
            leaves.append(Leaf(a, b, tuple(stack[-4:]) + (("fence",) if fenced else ()), hints, gap))
            gap = False
        elif newline and not hints:
            gap = True
        raw, plain, hints = [], [], []

    at = 0
    for m in TAG.finditer(hidden):
        raw.append(text[at : m.start()])
        plain.append(hidden[at : m.start()])
        at = m.end()
        token = m.group()
        if token == "\n":
            line = "".join(plain).strip()
            if line.startswith(("```", "~~~")):
                hints.append("fence_line")
                close()
                fenced = not fenced
            else:
                close(newline=True)
            continue
        if token.startswith("<!--"):
            close()
            hints.append("comment")
            close()
            continue
        if token[0] == "\\":
            name = "env:" + token[token.index("{") + 1 : -1].rstrip("*")
            close()
            if token.startswith("\\begin"):
                stack.append(name)
            elif name in stack:
                while stack.pop() != name:
                    pass
            hints.append(name)
            continue
        name = regex.match(r"</?([A-Za-z0-9]+)", token).group(1).lower()
        closing = token[1] == "/"
        if name in VOID_TAGS:
            hints.append("void:" + name)
            if name in BLOCK_TAGS:
                close()
        elif name in BLOCK_TAGS:
            if closing:
                hints.append("in:" + name)
                close()
                if name in stack:
                    while stack.pop() != name:
                        pass
            else:
                close()
                if name in ("p", "li") and stack and stack[-1] == name:
                    stack.pop()
                stack.append(name)
                hints.append("in:" + name)
        else:
            hints.append("inline:" + name)
            raw.append(token)
    raw.append(text[at:])
    plain.append(hidden[at:])
    close()
    return leaves


def marks(masked: str) -> list[str]:
    """What stands where marks are: each run of marks with the form of its surroundings, and each with the next."""
    form = "^" + SHAPE.sub(lambda m: "FCa0 "[m.lastindex - 1], masked.strip()) + "$"
    out, last, end = [], "", 0
    for m in RUN.finditer(form, 1, len(form) - 1):
        run, left, right = m.group()[:6], form[max(0, m.start() - 2) : m.start()], form[m.end() : m.end() + 2]
        out += ["m=" + run, f"l={left[-1:]}{run}", f"r={run}{right[:1]}", f"b={left[-1:]}{run}{right[:1]}", f"w={left}{run}{right}", f"rr={run}{right}"]
        if last:
            between = form[end : m.start()]
            out.append(f"p={last}>{run}:{'a' if between.strip('a ') == '' else between[:3] if len(between) < 4 else 'x'}{between[:1] == ' ':d}{between[-1:] == ' ':d}")
        last, end = run, m.end()
    return out


def features(leaves: list[Leaf]) -> list[list[str]]:
    """Names of the features that hold for each leaf: its ancestors, the forms around its marks, its outline, and its neighbours' beginnings."""
    out = []
    texts = [leaf.masked.strip() for leaf in leaves]
    before = "start"
    for k, (leaf, text) in enumerate(zip(leaves, texts)):
        names = ["bias", "parent=" + (leaf.path[-1] if leaf.path else "none")]
        names += ["anc=" + x for x in set(leaf.path)]
        names += ["hint=" + h for h in set(leaf.hints)]
        if leaf.path or leaf.hints:
            names.append("in_dom")
            names += {"kind=" + h.split(":")[0] for h in leaf.hints}
        solid = text.replace(MASK_FORMULA, "").replace(MASK_CODE, "").strip(" .,;:")
        if not solid:
            names.append("only_formula" if MASK_FORMULA in text else "only_code" if MASK_CODE in text else "nothing")
        elif MASK_FORMULA in text:
            names.append("has_formula")
        if ANY_MARK.search(text):
            names += set(marks(text))
        else:
            names.append("no_marks")
        n = len(solid)
        names.append("length=" + ("0" if n == 0 else "short" if n < 40 else "mid" if n < 160 else "long"))
        names.append("ends=" + ("stop" if solid != text and text[-1:] in ".;:," else "dot" if text.endswith(".") else "word" if text[-1:].isalnum() else "mark"))
        names.append("before=" + before)
        if k + 1 < len(texts):
            names.append("next=" + SHAPE.sub(lambda m: "FCa0 "[m.lastindex - 1], texts[k + 1][:24])[:3])
        before = ("dom" if leaf.path or leaf.hints else "") + SHAPE.sub(lambda m: "FCa0 "[m.lastindex - 1], text[:24])[:2]
        out.append(names)
    return out


def places(names: list[list[str]], known: dict[str, int] | None = None) -> list[np.ndarray]:
    """Hashed places of the features; ``known`` remembers them."""
    known = {} if known is None else known
    mask = (1 << SPACE_LOG2) - 1
    out = []
    for row in names:
        ids = []
        for name in row:
            at = known.get(name)
            if at is None:
                at = zlib.crc32(name.encode()) & mask
                if len(known) < 100_000:
                    known[name] = at
            ids.append(at)
        out.append(np.array(ids, np.int64))
    return out


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Crf:
    """Weights of a linear-chain CRF: features x labels, label to label, first and last label."""

    weights: np.ndarray
    steps: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @staticmethod
    def blank() -> Crf:
        k = len(LABELS)
        return Crf(np.zeros((1 << SPACE_LOG2, k)), np.zeros((k, k)), np.zeros(k), np.zeros(k))

    def unary(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.stack([self.weights[row].sum(axis=0) for row in rows])

    def viterbi(self, rows: list[np.ndarray]) -> list[int]:
        if not rows:
            return []
        u = self.unary(rows)
        score, back = u[0] + self.first, []
        for t in range(1, len(u)):
            step = score[:, None] + self.steps
            back.append(step.argmax(axis=0))
            score = step.max(axis=0) + u[t]
        at = int((score + self.last).argmax())
        path = [at]
        for b in reversed(back):
            at = int(b[at])
            path.append(at)
        return path[::-1]

    def marginals(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label at t) and the summed P(label at t, label at t + 1)."""
        n, k = u.shape
        a, b = np.empty((n, k)), np.empty((n, k))
        a[0] = u[0] + self.first
        for t in range(1, n):
            a[t] = u[t] + log_sum(a[t - 1][:, None] + self.steps, 0)
        b[-1] = self.last
        for t in range(n - 2, -1, -1):
            b[t] = log_sum(self.steps + (u[t + 1] + b[t + 1])[None, :], 1)
        z = log_sum(a[-1] + self.last, 0)
        node = np.exp(a + b - z)
        edge = np.zeros((k, k))
        for t in range(n - 1):
            edge += np.exp(a[t][:, None] + self.steps + (u[t + 1] + b[t + 1])[None, :] - z)
        return node, edge


def fit(pages: list[tuple[list[np.ndarray], list[int]]], epochs: int = 5, rate: float = 0.3, ridge: float = 1e-4, seed: int = 1) -> Crf:
    """Maximum likelihood by AdaGrad, a page a step."""
    crf, draw = Crf.blank(), random.Random(seed)
    power = [np.full_like(x, 1e-1) for x in (crf.weights, crf.steps, crf.first, crf.last)]
    pages = [p for p in pages if p[0]]
    for _ in range(epochs):
        draw.shuffle(pages)
        for rows, labels in pages:
            node, edge = crf.marginals(crf.unary(rows))
            node[np.arange(len(labels)), labels] -= 1
            wanted = np.zeros_like(edge)
            np.add.at(wanted, (labels[:-1], labels[1:]), 1)
            at = np.concatenate(rows)
            grad = np.repeat(node, [len(r) for r in rows], axis=0)
            where, inverse = np.unique(at, return_inverse=True)
            total = np.zeros((len(where), len(LABELS)))
            np.add.at(total, inverse, grad)
            total += ridge * crf.weights[where]
            power[0][where] += total**2
            crf.weights[where] -= rate * total / np.sqrt(power[0][where])
            for k, (x, g) in enumerate(((crf.steps, edge - wanted), (crf.first, node[0]), (crf.last, node[-1])), 1):
                g = g + ridge * x
                power[k] += g**2
                x -= rate * g / np.sqrt(power[k])
    return crf


# --- labelled pages ---------------------------------------------------------------


def plain_kind(leaf: Leaf) -> str | None:
    """The label of a leaf that bears no markup for certain: no tags, and characters of plain sentences alone; else None."""
    text = leaf.masked.strip()
    if leaf.path or leaf.hints or not BARE.fullmatch(text):
        return None
    if MASK_CODE in text and not text.strip(MASK_CODE + " "):
        return "code"
    if MASK_FORMULA in text and not text.strip(MASK_FORMULA + " ."):
        return "formula"
    return "item" if regex.match(r"-\s", text) else "text"


def plain_marks(draw: random.Random) -> str:
    """Plain text that holds marks: comparisons, powers, products, identifiers, bra-kets, numbered and labelled brackets."""
    v = lambda: draw.choice("abcfghkmnpqrstuvxyz") + draw.choice(("", "", "_1", "_2", "_n", "0", "_max"))
    n = lambda: str(draw.choice((draw.randrange(2, 20), draw.randrange(20, 5000), round(draw.random() * 100, 2))))
    word = lambda: draw.choice(("gap", "decay", "rate", "size", "value", "mean", "mass", "test", "max", "run", "energy", "flux"))
    forms = (
        lambda: f"{v()}{draw.choice((' < ', '<', ' > ', '>', '<=', ' >= ', ' << ', ' != ', ' == '))}{draw.choice((v(), n()))}",
        lambda: f"{draw.choice((v(), n()))}{draw.choice(('**', '^', '*', ' * ', ' ** ', '^-'))}{draw.choice((v(), n()))}",
        lambda: f"{v()}*{v()}*{v()}", lambda: f"{v()} * {v()} * {n()} = {n()}", lambda: f"{word()}_{word()}", lambda: f"{word()}_{word()}_{word()}", lambda: f"_{word()}", lambda: f"{word()}_",
        lambda: f"<{v()}|{v()}>", lambda: f"<{v()}|{v()}|{v()}>", lambda: f"|{v()}>", lambda: f"|{v()}|", lambda: f"{v()}[{draw.choice((v(), n()))}]", lambda: f"{v()}[{v()}][{v()}]", lambda: f"[{n()}]", lambda: f"[{draw.randrange(1, 30)}, {draw.randrange(30, 60)}]",
        lambda: f"[{word()} {word()}]", lambda: f"[{word()} of {word()} {draw.randrange(1, 9)}]", lambda: f"#{draw.randrange(1, 40)}", lambda: f"{draw.choice('CFRQ')}#", lambda: f"{draw.choice('ABQRT')}&{draw.choice('DJMT')}", lambda: f"{word()} & {word()}", lambda: f"~{n()}", lambda: f"~ {n()}",
        lambda: f"{v()} ~ {n()}", lambda: f"{{{v()}, {v()}}}", lambda: f"{v()} = {n()}", lambda: f"{v()} += {n()}", lambda: f"{v()} -> {v()}", lambda: f"{v()} => {v()}", lambda: f"@{word()}", lambda: f"http{draw.choice(('', 's'))}://{word()}.example/{word()}", lambda: f"the mark {draw.choice('*#_~|^&')} on line {draw.randrange(1, 30)}", lambda: f"{word()}@{draw.randrange(1, 6)}",
    )
    return draw.choice(forms)()


#: What stands in brackets without being markup.
LABEL_WORDS = ("cut", "end", "missing", "empty", "note", "continued", "sic", "unclear", "page", "end of text", "not given", "see below", "output ends", "part", "citation")


def with_marks(line: str, draw: random.Random) -> str:
    """A plain line with some plain text that holds marks put in between its words."""
    if draw.random() < 0.1:
        # a bracketed label after the text, or alone
        label = f"[{draw.choice(LABEL_WORDS)}{draw.choice(('', '', f' {draw.randrange(1, 9)}'))}]"
        return label if draw.random() < 0.2 else f"{line} {label}"
    spots = [m.start() for m in regex.finditer(r" ", regex.sub(r"\$[^$]*\$|```.*", lambda m: "\x01" * len(m.group()), line))]
    for at in sorted(draw.sample(spots, min(len(spots), draw.choice((1, 1, 2)))), reverse=True):
        line = line[:at] + " " + plain_marks(draw) + line[at:]
    return line


def emphasised(line: str, style: str, draw: random.Random) -> str:
    """One or two words outside formulas set in the markup of a style."""
    words = [m for m in regex.finditer(r"(?<![\w$\\{])\p{L}{3,}(?![\w$}])", regex.sub(r"\$[^$]*\$|```.*", lambda m: "\x01" * len(m.group()), line))]
    if not words:
        return line
    ways = {
        "html": ["<b>{}</b>", "<i>{}</i>", "<em>{}</em>", "<strong>{}</strong>", "<span>{}</span>", "<u>{}</u>", "<sub>{}</sub>", '<a href="x">{}</a>', "<font color=red>{}</font>", "&ldquo;{}&rdquo;", "{}&nbsp;", "&#8220;{}&#8221;", "<code>{}</code>", "&amp;{}"],
        "markdown": ["**{}**", "*{}*", "__{}__", "_{}_", "***{}***", "~~{}~~", "`{}`", "[{}](http://a.example/b)", "[{}][3]", "![{}](a.png)"],
        "wiki": ["''{}''", "'''{}'''", "[[{}]]", "[[a|{}]]", "{{{{term|{}}}}}", "{}<ref>note</ref>", "[http://a.example {}]", "{}{{{{note}}}}", "{{{{lang|xx|{}}}}}", "[[Some page#part|{}]]"],
        "latex": ["\\emph{{{}}}", "\\textit{{{}}}", "\\textbf{{{}}}", "\\underline{{{}}}", "\\mbox{{{}}}", "\\texttt{{{}}}", "{}~\\cite{{a}}", "{}~\\ref{{b}}", "{}\\footnote{{c}}", "\\href{{http://a.example}}{{{}}}", "{}\\label{{d}}", "{{\\it {}}}"],
    }[style]
    m = draw.choice(words)
    return line[: m.start()] + draw.choice(ways).format(m.group()) + line[m.end() :]


def rendered(kinds: list[tuple[str, str]], style: str, draw: random.Random) -> list[tuple[str, str]]:
    """(source text, label) pieces of a page in a style: plain pieces stay or are marked up."""
    out: list[tuple[str, str]] = []
    heavy = draw.random() < 0.6

    def para(line: str) -> tuple[str, str]:
        if draw.random() < 0.08:
            shown = {"html": ("<ul><li>{}</li></ul>", "<ol><li>{}</li></ol>"), "markdown": ("* {}", "+ {}", "  * {}"), "wiki": ("* {}", "** {}", "# {}", "*** {}"), "latex": ("\\item {}", "\\item[--] {}")}[style]
            return draw.choice(shown).replace("{}", line), "item+"
        if style == "html" and heavy and draw.random() < 0.9:
            inner = emphasised(line, style, draw) if draw.random() < 0.5 else line
            return draw.choice(("<p>{}</p>", '<p id="s1">{}</p>', "<p style='margin:0'>{}</p>", '<div class="note">{}</div>', "<P>{}</P>", "<section>{}</section>", "<center>{}</center>", "{}<br>", "{}<br/>")).replace("{}", inner), "text+"
        if draw.random() < (0.5 if heavy else 0.2):
            new = emphasised(line, style, draw)
            return new, "text+" if new != line else "text"
        if style == "latex" and draw.random() < 0.06:
            return draw.choice(("\\begin{center} {}", "\\begin{center} {} \\end{center}", "\\begin{quote} {}")).replace("{}", line), "text+"
        if style == "markdown" and draw.random() < 0.05:
            return "#" * draw.randrange(1, 5) + " " + line, "head+"
        if style == "latex" and draw.random() < 0.15:
            return draw.choice(("\\noindent {}", "{}\\\\", "{}\\newline", "\\vspace{{2pt}} {}", "{{\\it {}}}", "{{\\small {}}}")).replace("{{", "{").replace("}}", "}").replace("{}", line), "text+"
        if style == "markdown" and draw.random() < 0.12:
            return "> " + line, "quote+"
        return line, "text"

    title = " ".join(draw.sample(["Overview", "remarks", "method", "Notes", "first", "outline", "summary", "Proof"], 2))
    if draw.random() < 0.5:
        out.append({"html": (f"<h{draw.randrange(1, 5)}>{title}</h3>", "head+"), "markdown": ("#" * draw.randrange(1, 5) + " " + title, "head+"), "wiki": (f"== {title} ==", "head+"), "latex": (draw.choice(("\\section{%s}", "\\subsection*{%s}", "\\paragraph{%s}")) % title, "head+")}[style])
    elif style == "markdown" and draw.random() < 0.3:
        out += [(title, "head+"), ("=" * len(title), "head+")]
    k = 0
    while k < len(kinds):
        kind, line = kinds[k]
        if kind == "text":
            out.append(para(line))
        elif kind == "item":
            run = [line]
            while k + 1 < len(kinds) and kinds[k + 1][0] == "item":
                k += 1
                run.append(kinds[k][1])
            bare = [regex.sub(r"^\s*-\s+", "", x) for x in run]
            bare = [x if draw.random() < 0.7 else x.split(" ")[0][: draw.randrange(1, 12)] or "x" for x in bare]
            if draw.random() < 0.4:
                out += [(x, "item") for x in run]
            elif style == "html":
                out.append(("<ul>" + "".join(f"<li>{x}</li>" for x in bare) + "</ul>", "item+"))
            elif style == "latex":
                env = draw.choice(("itemize", "enumerate"))
                out.append(("\\begin{%s}" % env, "drop+"))
                out += [("\\item " + x, "item+") for x in bare]
                out.append(("\\end{%s}" % env, "drop+"))
            elif style == "markdown" and draw.random() < 0.4:
                out += [("| item | value |", "table+"), ("|---|---|", "table+")] + [(f"| {x.split(' with ')[0]} | {x} |", "table+") for x in bare]
            else:
                mark = draw.choice("*+") if style == "markdown" else draw.choice(("*", "#", "**"))
                out += [(f"{mark} {emphasised(x, style, draw)}", "item+") for x in bare]
        elif kind == "code":
            body = regex.sub(r"^```\w*\n|```$", "", line)
            if draw.random() < 0.5:
                out.append((line, "code"))
            elif style == "html":
                out.append((f"<pre><code>{html.escape(body, quote=False)}</code></pre>", "code+"))
            elif style == "wiki":
                out.append((draw.choice((f"<source lang=py>\n{body}</source>", f"<pre>\n{body}</pre>", f'<syntaxhighlight lang="py">\n{body}</syntaxhighlight>')), "code+"))
            elif style == "latex":
                out.append((f"\\begin{{python}}\n{body}\n\\end{{python}}", "code+"))
            else:
                out.append((f"```\n{body}```", "code+"))
        else:
            core = regex.sub(r"^\s*(?:\$\$|\\\[)|(?:\$\$|\\\])\s*$", "", line)
            if style == "latex" and draw.random() < 0.6:
                out.append((f"\\begin{{equation}}\n  {core} \\label{{eq:1}}\n\\end{{equation}}", "formula+"))
            elif style == "wiki" and draw.random() < 0.6:
                out.append((f"<math>{core}</math>", "formula+"))
            elif style == "html" and draw.random() < 0.5:
                out.append((f"<div>{line}</div>", "formula+"))
            else:
                out.append((line, "formula"))
        k += 1
    if draw.random() < 0.3:
        inner = draw.choice(("\\sqrt{x}", "\\frac{a}{b}", "x_1 + y^2", "\\sum_{k} a_k", "E = m c^2", "\\int f(x) dx", "a < b", "\\alpha \\beta = 1"))
        shown = {"html": f"<math>{inner}</math>", "wiki": f"<math>{inner}</math>", "latex": draw.choice(("\\begin{equation}\n%s\n\\end{equation}", "\\begin{align}\n%s\n\\end{align}", "\\begin{equation*}%s\\end{equation*}")) % inner, "markdown": f"$$ {inner} $$"}
        out.insert(draw.randrange(len(out) + 1), (shown[style], "formula" if style == "markdown" else "formula+"))
    if draw.random() < 0.15:
        out.insert(draw.randrange(len(out) + 1), {"html": ("<!-- " + " ".join(draw.sample(["begin", "of", "text", "part", "a", "todo", "check"], draw.randrange(1, 4))) + " -->", "drop+"), "markdown": ("---", "drop+"), "wiki": ("{{reflist}}", "text+"), "latex": ("\\newpage", "text+")}[style])
    return out


def labelled(pieces: list[tuple[str, str]], sep: str) -> tuple[list[Leaf], list[int]]:
    """Leaves of a page and the label of each: a leaf has the label of the piece it begins in."""
    leaves: list[Leaf] = []
    labels: list[int] = []
    text = sep.join(p for p, _ in pieces)
    single = [parse(p) for p, _ in pieces]
    whole = parse(text)
    if len(whole) != sum(map(len, single)):
        return [], []
    for part, (_, label) in zip(single, pieces):
        for leaf in part:
            empty = not leaf.masked.strip()
            labels.append(LABELS.index("drop+" if empty and label.endswith("+") else label))
    leaves = whole
    return leaves, labels


#: Pages to render where the sample has fewer plain ones.
OWN_PAGES = (
    "We start from the action and vary it.\nThe boundary term drops out (see above).\n- first case\n- second case\nSo the claim follows: the sum is finite.",
    "Let the length be fixed.\n$$ x = y $$\nThen $x$ grows, and the ratio of both is constant, as expected.\n```python\nprint(1)\n```",
    "Es sei die Länge fest. Dann wächst die Summe.\n- erster Fall\n- zweiter Fall\nDamit folgt die Behauptung.",
    "Soit la longueur fixe; alors la somme croît. Le résultat est donc fini.",
)
FEWEST_PAGES = 40


def train(texts: list[str], seed: int = 9) -> Crf:
    """Labelled pages from texts that are plain for certain: as they are, with plain text that holds marks, and rendered in four styles."""
    draw = random.Random(seed)
    bases = []
    for text in texts:
        leaves = parse(text)
        kinds = [plain_kind(leaf) for leaf in leaves]
        if leaves and None not in kinds:
            bases.append(list(zip(kinds, (leaf.raw for leaf in leaves))))
    while len(bases) < FEWEST_PAGES:
        leaves = parse(OWN_PAGES[len(bases) % len(OWN_PAGES)])
        bases.append(list(zip(map(plain_kind, leaves), (leaf.raw for leaf in leaves))))
    pages: list[tuple[list[np.ndarray], list[int]]] = []
    known: dict[str, int] = {}

    def put(pieces: list[tuple[str, str]]) -> None:
        got, labels = labelled(pieces, draw.choice(("\n", "\n\n")))
        if got:
            pages.append((places(features(got), known), labels))

    for base in bases:
        put([(line, kind) for kind, line in base])
        held = [(kind, with_marks(line, draw) if kind in ("text", "item") and draw.random() < 0.5 else line) for kind, line in base]
        # what is put in must not make another page of it
        held = [(kind, line) if len(parse(line)) == 1 and not parse(line)[0].hints else (kind, old) for (kind, line), (_, old) in zip(held, base)]
        put([(line, kind) for kind, line in held])
        for style in draw.sample(("html", "markdown", "wiki", "latex"), 3):
            put(rendered(held if draw.random() < 0.5 else base, style, draw))
    return fit(pages)


# --- clean text -------------------------------------------------------------------


def inline_clean(text: str) -> str:
    """A line without inline markup; formulas and code stay as they are."""
    kept: list[str] = []

    def keep(m: regex.Match) -> str:
        kept.append(html.unescape(m.group()) if regex.search(r"&(?:lt|gt|amp|nbsp|quot|#\d+);", m.group()) else m.group())
        return f"\x03{len(kept) - 1}\x03"

    text = PROTECTED.sub(keep, text)
    for _ in range(2):
        if "&" in text:
            text = html.unescape(text)
        text = regex.sub(r"<!--.*?(?:-->|\Z)|<ref[^<>]*>.*?</ref>|<ref[^<>]*/>", "", text, flags=regex.DOTALL)
        text = TAG.sub(lambda m: m.group() if m.group() == "\n" else " " if regex.match(r"<(?:br|hr)", m.group(), regex.IGNORECASE) else "", text)
    rules = (
        (r"!?\[([^\]\n]*)\]\([^)\n]*\)", r"\1"), (r"\[([^\]\n]+)\]\[[^\]\n]*\]", r"\1"), (r"\[https?://[^\]\s]+ ([^\]\n]*)\]", r"\1"), (r"\[\[(?:File|Image):[^\]]*\]\]", ""),
        (r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]", r"\1"), (r"\{\{(?:citation needed|reflist|cite|ref)[^{}]*\}\}", ""), (r"\{\{(?:[^{}|]*\|)*([^{}|]*)\}\}", r"\1"), (r"'{2,5}([^\n]*?)'{2,5}", r"\1"),
        (r"(?<![\w*\\])(\*{1,3})(?=[^\s*])([^*\n]*?)(?<=[^\s*])\1(?![\w*])", r"\2"), (r"(?<![\w_\\])(_{1,3})(?=[^\s_])([^_\n]*?)(?<=[^\s_])\1(?![\w_])", r"\2"), (r"~~([^~\n]*)~~", r"\1"), (r"(?<!`)`([^`\n]+)`(?!`)", r"\1"),
        (r"~?\\(?:cite|ref|label|eqref|footnote|vspace|hspace|pageref)\*?\{[^{}]*\}", ""), (r"\\href\{[^{}]*\}\{([^{}]*)\}", r"\1"), (r"\{\\(?:it|bf|em|sf|tt|small|large|sc|rm|tiny)\s+([^{}]*)\}?", r"\1"),
        (r"\\[A-Za-z]+\*?\{([^{}]*)\}", r"\1"), (r"\\(?:begin|end)\{[^{}]*\}", ""), (r"\\\\(?=\s|$)", ""), (r"\\(?:item|noindent|newline|newpage|clearpage|par|centering|small|it|bf)\b\s*", ""), (r"\\([%&#_{}])", r"\1"), (r"\\[A-Za-z]{2,}\*?\s*", ""),
        (r"^\s{0,3}(?:>+\s?)+", ""), (r"^\s{0,3}#{1,6}\s+", ""), (r"\s+#{1,6}\s*$", ""), (r"^\s*={2,6}\s*(.*?)\s*={2,6}\s*$", r"\1"), (r"^\s{0,3}[*+]\s+", ""),
    )
    for pattern, new in rules:
        text = regex.sub(pattern, new, text)
    text = regex.sub(r"[ \t\u00a0]+", " ", text).strip()
    return regex.sub(r"\x03(\d+)\x03", lambda m: kept[int(m.group(1))], text)


def clean(leaves: list[Leaf], labels: list[str]) -> str:
    """Plain text: headings stand alone, items begin with "- ", code is fenced as python, formulas stand in $."""
    out: list[str] = []
    code: list[str] = []
    formula: list[str] = []

    def flush() -> None:
        if code:
            body = "\n".join(code).strip("\n")
            if body.strip():
                out.append(f"```python\n{body}\n```")
            code.clear()
        if formula:
            body = regex.sub(r"\\label\{[^{}]*\}", "", " ".join(formula)).strip()
            if body:
                out.append(body if body.startswith(("$", "\\[")) else f"$${body}$$")
            formula.clear()

    for leaf, label in zip(leaves, labels):
        if label != "code+" and code or label != "formula+" and formula:
            flush()
        if leaf.gap and out and out[-1] and not code and not formula:
            out.append("")
        if label == "drop+":
            continue
        if label in ("text", "item", "code", "formula"):
            out.append(leaf.raw.strip() if label == "code" else leaf.raw.rstrip())
        elif label == "code+":
            line = html.unescape(TAG.sub("", leaf.raw)) if "fence" not in leaf.path else leaf.raw
            if not line.strip().startswith(("```", "~~~")):
                code.append(line)
        elif label == "formula+":
            formula.append(html.unescape(TAG.sub("", leaf.raw)))
        elif label == "table+":
            cells = [inline_clean(c) for c in leaf.raw.strip().strip("|").split("|")]
            if not all(regex.fullmatch(r":?-+:?|", c.strip()) for c in cells):
                out.append("- " + "; ".join(c for c in cells if c))
        elif label == "head+":
            if not regex.fullmatch(r"\s*[=~-]+\s*", leaf.raw):
                out.extend(["", inline_clean(leaf.raw), ""])
        elif label == "item+":
            body = inline_clean(leaf.raw)
            if body:
                out.append("- " + body)
        else:
            body = inline_clean(leaf.raw)
            if body:
                out.append(body)
    flush()
    return regex.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n")


# --- operators --------------------------------------------------------------------


def fields_of(tables: list[tuple[str, DataFrame, str, list[str]]]) -> DataFrame:
    """(table_name, row_id, field_name, text) from (name, frame, id column, text columns)."""
    parts = []
    for name, frame, id_col, columns in tables:
        # all columns from one scan
        each = F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(c).cast("string").alias("text")) for c in columns)))
        parts.append(frame.select(F.lit(name).alias("table_name"), F.col(id_col).cast("bigint").alias("row_id"), each.alias("_f")).select("table_name", "row_id", "_f.*"))
    return reduce(DataFrame.unionByName, parts)


def model_for(values: DataFrame, sample_rows: int = 900) -> Crf | None:
    """The CRF, fitted on at most ``sample_rows`` of the values; None where there are none."""
    rows = sample(values.where("text is not null and trim(text) <> ''").select("row_id", "text"), "row_id", sample_rows)
    return train([r["text"] for r in rows]) if rows else None


def read(values: DataFrame, crf: Crf | None, with_text: bool) -> DataFrame:
    """(table_name, row_id, field_name, marked leaves, kinds, clean text) of every value.

    Null and empty texts have no leaves and stay null and empty; without a model (no texts
    at all) nothing is marked. Repeated rows are read alike. One narrow pass over whole texts.
    """
    # plain arrays: what is broadcast is unpickled where this package need not be installed
    sent = values.sparkSession.sparkContext.broadcast(None if crf is None else (crf.weights.astype(np.float32), crf.steps, crf.first, crf.last))

    def run(frames):
        model, known = None if sent.value is None else Crf(*sent.value), {}
        for frame in frames:
            marked, kinds, texts = [], [], []
            for text in frame["text"]:
                leaves = parse(text) if text and model is not None else []
                path = model.viterbi(places(features(leaves), known)) if leaves else []
                marked.append(sum(MARKED[k] for k in path))
                kinds.append([LABELS[k] for k in path] if with_text else None)
                texts.append(clean(leaves, [LABELS[k] for k in path]) if with_text and leaves else text)
            yield pd.DataFrame({"table_name": frame["table_name"], "row_id": frame["row_id"], "field_name": frame["field_name"], "marked": marked, "kinds": pd.Series(kinds, dtype=object), "clean_text": pd.Series(texts if with_text else [None] * len(texts), dtype=object)})

    return values.mapInPandas(run, "table_name string, row_id bigint, field_name string, marked bigint, kinds array<string>, clean_text string")


def found(values: DataFrame, crf: Crf | None) -> DataFrame:
    """Values of which the CRF labels at least one leaf as marked up."""
    return read(values, crf, False).where("marked > 0").select("table_name", "row_id", "field_name")


def cleaned(values: DataFrame, crf: Crf | None) -> DataFrame:
    """Every value with its clean text, the number of marked leaves and the kinds of its leaves."""
    return read(values, crf, True)
