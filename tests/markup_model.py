"""A slow model of page markup: a character-by-character state machine, a real
element tree, and recursive text.  Independent of the engine's patterns."""

import html

SPACE = "\t\n\f\r "
RAW = ("script", "style")
VOID = "area base br col embed hr img input keygen link meta param source track wbr".split()
BLOCKS = """address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
head header hgroup html li main menu nav noscript ol pre section summary table tbody td template tfoot th thead tr ul""".split()


def letter(c):
    return c.isascii() and c.isalpha()


def read_tag(page, i):
    """Attributes from position ``i`` on, and the position after '>'; None at the page's end."""
    attrs, slash = [], False
    n = len(page)
    while i < n:
        c = page[i]
        if c == ">":
            return attrs, i + 1, slash
        if c in SPACE or c == "/":
            slash = c == "/"
            i += 1
            continue
        slash = False
        name = c
        i += 1
        while i < n and page[i] not in SPACE + "/>=":
            name += page[i]
            i += 1
        j = i
        while j < n and page[j] in SPACE:
            j += 1
        value = ""
        if j < n and page[j] == "=":
            i = j + 1
            while i < n and page[i] in SPACE:
                i += 1
            if i < n and page[i] in "\"'" and page.find(page[i], i + 1) > 0:
                end = page.find(page[i], i + 1)
                value, i = page[i + 1:end], end + 1
            else:
                while i < n and page[i] not in SPACE + ">":
                    value += page[i]
                    i += 1
        attrs.append((name.lower(), value))
    return None


def events(page):
    out, i, n, text = [], 0, len(page), ""

    def flush():
        nonlocal text
        if text:
            out.append(("text", text))
        text = ""

    while i < n:
        c = page[i]
        nxt = page[i + 1] if i + 1 < n else ""
        after = page[i + 2] if i + 2 < n else ""
        if c != "<" or not (letter(nxt) if nxt not in ("/", "!", "?") else True) or not nxt:
            text += c
            i += 1
            continue
        closing = nxt == "/" and letter(after)
        if letter(nxt) or closing:
            flush()
            j = i + 1 + closing
            name = ""
            while j < n and page[j] not in SPACE + "/>":
                name += page[j]
                j += 1
            got = read_tag(page, j)
            if got is None:
                return out
            attrs, i, slash = got
            name = name.lower()
            if closing:
                out.append(("end", name))
                continue
            first = {}
            for k, v in attrs:
                first.setdefault(k, v)
            out.append(("start", name, first))
            if name in RAW:
                j = i
                while j < n and not (page[j:j + 2 + len(name)].lower() == "</" + name and page[j + 2 + len(name):j + 3 + len(name)] in tuple(SPACE + "/>")):
                    j += 1
                if j > i:
                    out.append(("text", page[i:j]))
                out.append(("end", name))
                if j >= n:
                    return out
                got = read_tag(page, j + 2 + len(name))
                if got is None:
                    return out
                i = got[1]
            elif slash:
                out.append(("end", name))
            continue
        flush()
        if page.startswith("<!--", i):
            end = page.find("-->", i + 2)
            if end < 0:
                return out
            i = end + 3
        else:
            end = page.find(">", i + 2)
            if end < 0:
                return out
            i = end + 1
    flush()
    return out


class Node:
    def __init__(self, name, attrs, parent):
        self.name, self.attrs, self.parent, self.kids = name, attrs, parent, []


def tree(page):
    root = here = Node("#root", {}, None)

    def up(name, cross):
        """The nearest open element of that name, not looking out of a block unless ``cross``."""
        x = here
        while x.parent is not None:
            if x.name == name:
                return x
            if x.name in BLOCKS and not cross:
                return None
            x = x.parent
        return None

    for e in events(page):
        if e[0] == "text":
            here.kids.append(e[1])
        elif e[0] == "start":
            name = e[1]
            if name in BLOCKS or name == "p":
                x = up("p", False)
                here = x.parent if x else here
            elif name == "a":
                x = up("a", False)
                here = x.parent if x else here
            if name not in "title meta link script style base noscript template".split():
                x = up("head", True)
                here = x.parent if x else here
            node = Node(name, e[2], here)
            here.kids.append(node)
            if name not in VOID:
                here = node
        else:
            x = up(e[1], e[1] in BLOCKS)
            here = x.parent if x else here
    return root


def texts(node, hidden):
    out, stack = [], [iter(node.kids)]
    while stack:
        k = next(stack[-1], stack)
        if k is stack:
            stack.pop()
        elif isinstance(k, str):
            if t := html.unescape(k).strip():
                out.append(t)
        elif k.name not in hidden:
            stack.append(iter(k.kids))
    return out


def nodes(node):
    for k in node.kids:
        if not isinstance(k, str):
            yield k
            yield from nodes(k)
