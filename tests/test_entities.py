import html
import random
from html.entities import html5

from voxlake.functions import web as W


def test_entities_as_the_standard_has_them(one):
    pick = random.Random(1)
    names = sorted(html5)
    texts = [f"a&{name}b" for name in pick.sample(names, 250)] + [f"&{n}" for n in names[:120]]
    texts += ["", "&", "&&amp;", "&;", "&#;", "&#x;", "&#xg;", "&amp", "&ampx;y", "&notit;", "&notin;",
              "&nosuchname;", "&lt&gt", "&#38", "&#038;#", "&#x26;&#X26", "& amp;", "&a b;", "&é;",
              "&" + "x" * 40 + ";", "&amp;amp;", "x&copy;&copyy", "&#99999999999999999999;", "&#xD800;",
              "&#x110000;", "&#x10FFFF;", "&#xFFFE;", "&#xFDD0;", "&#x1F600;", "&#0;", "&#00000000065;"]
    texts += [f"&#{n};" for n in [*range(0, 170), 0xFFFD, 0xD7FF, 0xE000, 0x1FFFF, 0x20000]]
    pieces = ["&", "#", "x", "amp", "lt", ";", "6", "41", " ", "not", "in", "A", "é", "\n", "<"]
    texts += ["".join(pick.choice(pieces) for _ in range(9)) for _ in range(600)]
    assert one(W.unescape_entities, texts) == [html.unescape(t) for t in texts]
    assert one(W.unescape_entities, [None]) == [None]
