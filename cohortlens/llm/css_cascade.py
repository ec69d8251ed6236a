"""Which `display`, `visibility` and `white-space` a page's own style sheets give an element.

Every declaration of the two properties is kept with its importance, layer,
specificity and order, and the winning one decides. Rules in @media blocks hold
where a screen of `WIDTH` x `HEIGHT` pixels fits the condition; those in
@supports hold, unless negated; other conditions (@container, @scope) and
features not known here don't, so that text is rather shown than lost.

Selectors are compound ones with all combinators, attributes, :is, :where, :not,
nesting, and the tree's :root, :empty and child positions. States that a page
has not when it opens (:hover, :target, ...), pseudo-elements and unknown
pseudo-classes match nothing. Style rules nested deeper than `NESTED` are left.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import pairwise
from typing import Any, NamedTuple

WIDTH, HEIGHT = 1280, 800
NESTED = 16

TOKEN = re.compile(r"""/\*.*?(?:\*/|\Z)|"(?:\\.|[^"\\\n])*"?|'(?:\\.|[^'\\\n])*'?|\([^(){}]*\)|\\.|[{};]|[^"'{};\\/(]+|.""", re.S)
ASKED = re.compile(r"display|visibility|white-space", re.I)
DECLARED = re.compile(r"\s*(display|visibility|white-space)\s*:\s*(.*?)\s*(!\s*important)?\s*\Z", re.I | re.S)
DISPLAYS = re.compile(r"(none|contents|block|inline|flow|flow-root|list-item|run-in|(inline-)?(block|flex|grid|table)|table-[a-z-]+|ruby[a-z-]*|-webkit-(inline-)?(box|flex)|math|inherit|initial|unset|revert|revert-layer)(\s+[a-z-]+)*\Z|.*var\(", re.I | re.S)
SPACES = frozenset("normal nowrap pre pre-wrap pre-line break-spaces inherit initial unset revert revert-layer".split())
VISIBILITIES = frozenset("visible hidden collapse inherit initial unset revert revert-layer".split())
PART = re.compile(r"""\s*([>+~])\s*|(\s+)|([*&])|([.#]?)((?:[\w-]|[^\x00-\x7f]|\\.)+)|\[\s*([\w-]+)\s*(?:([~|^$*]?=)\s*("[^"]*"|'[^']*'|[^\]\s]+)\s*([iIsS])?\s*)?\]|(::?)([\w-]+)(\()?""")
FEATURE = re.compile(r"\(\s*(?:(min-|max-)?([a-z-]+)\s*(?::\s*([^()]*?))?|([^()<>=]*?)\s*([<>]=?)\s*([^()<>=]*?)\s*(?:([<>]=?)\s*([^()<>=]*?))?)\s*\)")
LENGTH = re.compile(r"([\d.]+)(px|em|rem|pt|in|cm)?\Z")
UNITS = {None: 1, "px": 1, "em": 16, "rem": 16, "pt": 4 / 3, "in": 96, "cm": 96 / 2.54}
SIZES = {"width": WIDTH, "height": HEIGHT, "device-width": WIDTH, "device-height": HEIGHT}
#: what else is known of the screen; a feature without a value asks for any but the first word
FEATURES = {
    "orientation": "landscape", "prefers-color-scheme": "light", "prefers-reduced-motion": "no-preference", "prefers-contrast": "no-preference",
    "hover": "hover", "any-hover": "hover", "pointer": "fine", "any-pointer": "fine", "scripting": "enabled", "color": "", "forced-colors": "none", "update": "fast", "display-mode": "browser",
}


def length(text: str) -> float | None:
    try:
        return float(m[1]) * UNITS[m[2]] if (m := LENGTH.match(text.strip())) else None
    except ValueError:
        return None


def fits(m: re.Match[str]) -> bool:
    """Whether the screen has a media feature."""
    end, name, value = m[1], m[2], m[3]
    if m[5]:  # (400px <= width < 700px)
        texts, signs = [m[4], m[6], *([m[8]] if m[8] else [])], [m[5], *([m[7]] if m[7] else [])]
        numbers = [SIZES.get(t.strip(), length(t)) for t in texts]
        if None in numbers:
            return False
        test = {"<": float.__lt__, "<=": float.__le__, ">": float.__gt__, ">=": float.__ge__}
        return all(test[s](float(a), float(b)) for s, (a, b) in zip(signs, pairwise(numbers), strict=True))
    if name in SIZES:
        size = None if value is None else length(value)
        if size is None:
            return value is None and not end
        return SIZES[name] >= size if end == "min-" else SIZES[name] <= size if end == "max-" else SIZES[name] == size
    if end or name not in FEATURES:
        return False
    return FEATURES[name] not in ("none", "no-preference") if value is None else value.strip() == FEATURES[name]


def on_screen(query: str) -> bool:
    """Whether a media query list holds on the screen."""
    return not query.strip() or any(holds(q) for q in query.lower().split(","))


def holds(query: str) -> bool:
    words = query.split("(", 1)[0].split()
    negated = words[:1] == ["not"]
    kind = next((w for w in words if w not in ("not", "only", "and", "or")), "all")
    if FEATURE.sub("", query).count("("):
        return False  # a condition in a condition: not known
    tests = [fits(m) for m in FEATURE.finditer(query)]
    if any(m[2] and m[2] not in SIZES and m[2] not in FEATURES for m in FEATURE.finditer(query)):
        return False
    rest = re.split(r"\s+", FEATURE.sub(" ", query).strip())
    good = kind in ("all", "screen") and ((any if "or" in rest else all)(tests) if tests else True)
    if rest.count("not") > negated:
        return False
    return good != negated


class Selector(NamedTuple):
    """Compounds from the right: (combinator to the one before, tag, tests)."""

    parts: tuple[tuple[str, str, tuple[Callable[[Any], bool], ...]], ...]
    weight: tuple[int, int, int]
    key: str  # what an element must have: "#id", ".class", tag or ""


def name_of(text: str) -> str:
    return re.sub(r"\\([0-9a-fA-F]{1,6})\s?|\\(.)", lambda m: (chr(c) if 0 < (c := int(m[1], 16)) < 0x110000 else "\ufffd") if m[1] else m[2], text, flags=re.S)


def attribute_test(name: str, how: str | None, value: str | None, flag: str | None) -> Callable[[Any], bool]:
    value = (value[1:-1] if value[0] in "\"'" else value) if value else ""
    fold = str.lower if (flag or "") in ("i", "I") or name in ("type", "dir", "lang", "align") else str
    value, name = fold(value), name.lower()
    tests: dict[str | None, Callable[[str], bool]] = {
        None: lambda a: True, "=": lambda a: a == value, "~=": lambda a: value in a.split(), "|=": lambda a: a == value or a.startswith(value + "-"),
        "^=": lambda a: bool(value) and a.startswith(value), "$=": lambda a: bool(value) and a.endswith(value), "*=": lambda a: bool(value) and value in a,
    }
    return lambda node: name in node.attributes and tests[how](fold(node.attributes[name]))


def position_test(argument: str, last: bool, typed: bool) -> Callable[[Any], bool] | None:
    text = {"odd": "2n+1", "even": "2n"}.get(argument.strip().lower(), re.sub(r"\s", "", argument.lower()))
    m = re.match(r"(?:([+-]?\d{0,6})n)?([+-]?\d{1,6})?\Z", text)
    if not text or not m:
        return None
    step = 0 if m[1] is None else int(m[1] + "1" if m[1] in ("", "+", "-") else m[1])
    first = int(m[2] or 0)

    def test(node: Any) -> bool:
        if node.kin is None:
            return False
        own = node.kin.place(node, last, typed)
        return own == first if not step else (own - first) % step == 0 and (own - first) // step >= 0

    return test


PLACES = {"first-child": ("1", False, False), "last-child": ("1", True, False), "first-of-type": ("1", False, True), "last-of-type": ("1", True, True)}
NTH = {"nth-child": (False, False), "nth-last-child": (True, False), "nth-of-type": (False, True), "nth-last-of-type": (True, True)}
OF_INPUT = {"checked": ("checked", "selected"), "disabled": ("disabled",), "required": ("required",)}


def pseudo_test(name: str, argument: str | None, parent: list[Selector], depth: int) -> tuple[Callable[[Any], bool], tuple[int, int, int]] | None:
    name = name.lower()
    if argument is not None and name in ("is", "where", "not", "matches", "-webkit-any") and depth < NESTED:
        inner, known = selectors(argument, parent, depth + 1)
        if name == "not" and not known:
            return None
        weight = (0, 0, 0) if name == "where" else max((s.weight for s in inner), default=(0, 0, 0))
        return (lambda node: any(matches(node, s) for s in inner) != (name == "not")), weight
    test = None
    if argument is not None and name in NTH:
        test = position_test(argument, *NTH[name])
    elif argument is None:
        if name in PLACES:
            test = position_test(*PLACES[name])
        elif name in ("only-child", "only-of-type"):
            ends = [position_test("1", last, name == "only-of-type") for last in (False, True)]
            test = lambda node: all(t(node) for t in ends if t)
        elif name == "root":
            test = lambda node: node.name == "html"
        elif name == "empty":
            test = lambda node: not any(node.children)
        elif name in ("link", "any-link"):
            test = lambda node: node.name in ("a", "area") and "href" in node.attributes
        elif name in OF_INPUT:
            test = lambda node: any(a in node.attributes for a in OF_INPUT[name])
        elif name == "enabled":
            test = lambda node: node.name in ("input", "button", "select", "textarea", "option") and "disabled" not in node.attributes
        elif name in ("hover", "focus", "active", "target", "visited", "focus-within", "focus-visible", "target-within", "fullscreen", "popover-open", "modal"):
            test = lambda node: False
    return None if test is None else (test, (0, 1, 0))


def selectors(text: str, parent: list[Selector], depth: int = 0, nested: bool = False) -> tuple[list[Selector], bool]:
    """(those of a list that are known here, whether all are)."""
    found, all_known, at = [], True, 0
    while at <= len(text):
        one, at = selector(text, at, parent, depth, nested)
        if one is None:
            all_known = False
        else:
            found.append(one)
    return found, all_known


def selector(text: str, at: int, parent: list[Selector], depth: int, nested: bool) -> tuple[Selector | None, int]:
    """(the one that begins here, the place behind its comma)."""
    end, level, quote = at, 0, ""
    while end < len(text):
        c = text[end]
        if quote:
            quote = "" if c == quote else quote
        elif c in "\"'":
            quote = c
        elif c == "\\":
            end += 1
        elif c in "([":
            level += 1
        elif c in ")]":
            level -= 1
        elif c == "," and not level:
            break
        end += 1
    body, after = text[at:end].strip(), end + 1
    compounds: list[tuple[str, str, tuple[Callable[[Any], bool], ...]]] = []
    weight, tag, key, tests, comb, any_part, amper = [0, 0, 0], "", "", [], "", False, False
    i = 0
    while i < len(body):
        m = PART.match(body, i)
        if not m:
            return None, after
        i = m.end()
        if m[1] or m[2]:
            if any_part:
                compounds.append((comb, tag, tuple(tests)))
            elif not (nested and not compounds and m[1]):
                return None, after
            if nested and not compounds:
                compounds.append(("", "", (lambda node: any(matches(node, s) for s in parent),)))
                amper = True
            comb, tag, key, tests, any_part = m[1] or " ", "", "", [], False
            continue
        any_part = True
        if m[3] == "&":
            amper = True
            tests.append(lambda node: any(matches(node, s) for s in parent))
            top = max((s.weight for s in parent), default=(0, 0, 0))
            weight = [a + b for a, b in zip(weight, top, strict=True)]
        elif m[5]:
            name = name_of(m[5])
            if m[4] == "#":
                key = "#" + name
                tests.append(lambda node, n=name: node.attributes.get("id") == n)
                weight[0] += 1
            elif m[4] == ".":
                key = key if key[:1] == "#" else "." + name
                tests.append(lambda node, n=name: n in node.attributes.get("class", "").split())
                weight[1] += 1
            else:
                tag = name.lower()
                weight[2] += 1
        elif m[6]:
            tests.append(attribute_test(m[6], m[7], m[8], m[9]))
            weight[1] += 1
        elif m[10]:
            argument = None
            if m[12]:
                level, start = 1, i
                while i < len(body) and level:
                    level += {"(": 1, ")": -1}.get(body[i], 0)
                    i += 1
                argument = body[start : i - 1 if not level else i]
            made = pseudo_test(m[11], argument, parent, depth) if m[10] == ":" else None
            if made is None:
                return None, after
            tests.append(made[0])
            weight = [a + b for a, b in zip(weight, made[1], strict=True)]
    if not any_part:
        return None, after
    compounds.append((comb, tag, tuple(tests)))
    if nested and not amper:  # ".a { .b {} }" is ".a .b"
        compounds[0] = (" ", *compounds[0][1:])
        compounds.insert(0, ("", "", (lambda node: any(matches(node, s) for s in parent),)))
        amper = True
        top = max((s.weight for s in parent), default=(0, 0, 0))
        weight = [a + b for a, b in zip(weight, top, strict=True)]
    turned = []
    for n in range(len(compounds) - 1, -1, -1):  # each with the combinator to its right
        turned.append((compounds[n + 1][0] if n + 1 < len(compounds) else "", *compounds[n][1:]))
    return Selector(tuple(turned), (weight[0], weight[1], weight[2]), key or tag), after


def fit(node: Any, part: tuple) -> bool:
    # a page without these tags has the elements all the same
    return (not part[1] or node.name == part[1] or node.name == "#root" and part[1] in ("html", "body")) and all(test(node) for test in part[2])


def matches(node: Any, one: Selector) -> bool:
    at = [node] if fit(node, one.parts[0]) else []
    for part in one.parts[1:]:
        found, seen = [], set()
        for n in at:
            if part[0] in (" ", ">"):
                p = n.parent
                while p is not None and id(p) not in seen:
                    seen.add(id(p))
                    if fit(p, part):
                        found.append(p)
                    p = p.parent if part[0] == " " else None
            elif n.kin is not None:
                for p in n.kin.before(n, part[0] == "+"):
                    if id(p) in seen:
                        break
                    seen.add(id(p))
                    if fit(p, part):
                        found.append(p)
        at = found
        if not at:
            break
    return bool(at)


class Kin:
    """The elements among one parent's children."""

    def __init__(self, nodes: list):
        self.nodes, self.of_type = nodes, {}
        for i, n in enumerate(nodes):
            n.at = i
        self.typed: dict[int, int] = {}
        for n in nodes:
            same = self.of_type.setdefault(n.name, [])
            self.typed[id(n)] = len(same)
            same.append(n)

    def place(self, node: Any, last: bool, typed: bool) -> int:
        own, number = (self.typed[id(node)], len(self.of_type[node.name])) if typed else (node.at, len(self.nodes))
        return number - own if last else own + 1

    def before(self, node: Any, nearest: bool) -> Iterator[Any]:
        for i in range(node.at - 1, max(node.at - 2, -1) if nearest else -1, -1):
            yield self.nodes[i]


def relate(root: Any) -> None:
    """Gives each element its parent and its place among its kin."""
    stack = [root]
    while stack:
        node = stack.pop()
        own = [c for c in node.children if not isinstance(c, str)]
        kin = Kin(own)
        for c in own:
            c.parent, c.kin = node, kin
        stack += own


def declaration(text: str) -> tuple[str, str, bool] | None:
    m = DECLARED.match(text)
    if not m:
        return None
    name, value = m[1].lower(), m[2].lower()
    good = DISPLAYS.match(value) if name == "display" else value in (SPACES if name == "white-space" else VISIBILITIES) or "var(" in value
    return (name, value, bool(m[3])) if good else None


def declarations(text: str) -> list[tuple[str, str, bool]]:
    """Those of a style attribute."""
    parts = [""]
    for t in TOKEN.findall(text):
        if t == ";":
            parts.append("")
        elif not t.startswith("/*"):
            parts[-1] += t
    return [d for p in parts if (d := declaration(p))]


class Sheet:
    """The page's rules by what their last compound asks for."""

    def __init__(self) -> None:
        self.rules: dict[str, list[tuple[Selector, str, str, bool, float, int]]] = {}
        self.layers: dict[str, int] = {}
        self.order = 0

    def layer(self, name: str, outer: float) -> float:
        return outer if outer != float("inf") else self.layers.setdefault(name.split(".")[0].strip(), len(self.layers))

    def add(self, css: str) -> None:
        #: (the selectors whose declarations stand here, whether the block holds, layer, depth of style rules)
        stack: list[tuple[list[Selector] | None, bool, float, int]] = [(None, True, float("inf"), 0)]
        said: list[str] = []

        def flush() -> None:
            own, holds, layer, _ = stack[-1]
            if own and holds and (d := declaration("".join(said))):
                for one in own:
                    self.rules.setdefault(one.key, []).append((one, *d, layer, self.order))
                self.order += 1
            said.clear()

        for t in TOKEN.findall(css):
            if t == "{":
                text = "".join(said).strip()
                said.clear()
                own, holds, layer, depth = stack[-1]
                if not holds:
                    stack.append((None, False, layer, depth))
                elif text.startswith("@"):
                    word, rest = re.match(r"@([\w-]*)\s*(.*)", text, re.S).groups()
                    word = word.lower()
                    if word == "layer":
                        stack.append((own, True, self.layer(rest.strip() or f"#{self.order}:{len(self.layers)}", layer), depth))
                    else:
                        stack.append((own, word == "media" and on_screen(rest) or word == "supports" and not rest.strip().lower().startswith("not"), layer, depth))
                elif depth >= NESTED:
                    stack.append((None, False, layer, depth))
                else:
                    stack.append((selectors(text, own or [], depth, own is not None)[0], True, layer, depth + 1))
            elif t == "}":
                flush()
                if len(stack) > 1:
                    stack.pop()
            elif t == ";":
                text = "".join(said).strip()
                if text[:7].lower() == "@layer " and stack[-1][1]:
                    for name in text[7:].split(","):
                        self.layer(name, stack[-1][2])
                flush()
            elif not t.startswith("/*") and t not in ("<!--", "-->"):
                said.append(t.replace("<!--", " ").replace("-->", " ") if stack[-1][0] is None else t)
        flush()

    def won(self, node: Any) -> dict[str, str]:
        """{property: value} of the winning declarations, the style attribute's included."""
        best: dict[str, tuple[tuple, str]] = {}
        a = node.attributes
        if self.rules and node.name[0] != "#":
            keys = ["", node.name, *("." + c for c in set(a.get("class", "").split())), *(["#" + a["id"]] if "id" in a else [])]
            for key in keys:
                for one, name, value, important, layer, order in self.rules.get(key, ()):
                    rank = (important, 0, -layer if important else layer, one.weight, order)
                    if (name not in best or best[name][0] < rank) and matches(node, one):
                        best[name] = (rank, value)
        if "style" in a and ASKED.search(a["style"]):
            for order, (name, value, important) in enumerate(declarations(a["style"])):
                rank = (important, 1, 0.0, (0, 0, 0), order)
                if name not in best or best[name][0] < rank:
                    best[name] = (rank, value)
        return {name: value for name, (_, value) in best.items()}
