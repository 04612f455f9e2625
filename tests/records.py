"""Small invented records."""

from __future__ import annotations

import io
import tarfile
from xml.sax.saxutils import escape, quoteattr

NAMESPACE = "http://www.loc.gov/MARC21/slim"


def field(tag, *parts, ind1=" ", ind2=" "):
    inner = "".join(f"<subfield code={quoteattr(c)}>{escape(v)}</subfield>" for c, v in parts)
    return f'<datafield tag="{tag}" ind1="{ind1}" ind2="{ind2}">{inner}</datafield>'


def marc(ident, *fields):
    return f'<record><leader>00000nam</leader><controlfield tag="001">{ident}</controlfield>{"".join(fields)}</record>'


def collection(*records):
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<collection xmlns="{NAMESPACE}">' + "\n".join(records) + "</collection>"


P1, P2, P3, P4 = "9910367273103811", "9910367273003811", "9910367272903811", "9910367272803811"
SHARED, CHILD = "991012069669703811", "991022063789703811"
PARENTS = collection(
    marc(
        P1, field("ITM", ("a", "first item")), field("ITM", ("a", "last item")), field("HLD", ("h", " HD72 "), ind1="0"),
        *[field("774", ("w", f"99100693{n}09703811")) for n in (24, 27, 77, 22, 31)],
    ),
    marc(P2, field("ITM", ("a", "p2 item")), field("HLD", ("b", "KARDON")), field("774", ("w", "991031640129703811")), field("774", ("w", SHARED))),
    marc(P3, field("ITM", ("a", "p3 item")), field("HLD", ("b", "p_remote")), field("774", ("w", CHILD)), field("774", ("w", SHARED))),
    marc(P4, field("774", ("w", " 9912343811 "), ("w", "(OCoLC)99")), field("774", ("w", "993811"), ("t", "x"), ("w", "99x3811"), ("w", ""))),
)
CHILDREN = collection(
    marc(CHILD, field("245", ("a", "A & B <i>"))), marc(SHARED, field("245", ("a", "shared"))),
    marc("991111111113811", field("245", ("a", "alone"))), marc("on123", field("245", ("a", "no number"))),
)


def archive(path, *members):
    with tarfile.open(path, "w:gz") as out:
        for name, text in members:
            body = text.encode("utf-8")
            entry = tarfile.TarInfo(name)
            entry.size = len(body)
            out.addfile(entry, io.BytesIO(body))
    return str(path)


def oai(ident, stamp, sets, body="", status=None, prefix=""):
    state = f' status="{status}"' if status else ""
    named = "".join(f"<setSpec>{s}</setSpec>" for s in sets)
    return (
        f"<record><header{state}><identifier>oai:x:{ident}</identifier><datestamp>{stamp}</datestamp>{named}</header>"
        + (f"<metadata>{body}</metadata>" if body else "") + "</record>"
    )


def oai_collection(*records):
    return '<?xml version="1.0"?>\n<collection xmlns="http://www.openarchives.org/OAI/2.0/">' + "".join(records) + "</collection>"


def el(name, *inner):
    return f'<element name="{name}">{"".join(inner)}</element>'


def val(*values, name="value"):
    return "".join(f'<field name="{name}">{escape(v)}</field>' for v in values)


def thesis(*dc, bundles=""):
    """A repository record in the form it is harvested: prefixed, with a doubled wrapper."""
    body = f'<metadata xmlns="http://www.lyncode.com/xoai">{el("dc", *dc)}{bundles}</metadata>'
    return (
        '<?xml version="1.0"?><collection><ns0:record xmlns:ns0="http://www.openarchives.org/OAI/2.0/">'
        "<ns0:header><ns0:identifier>oai:s:1</ns0:identifier><ns0:datestamp>2020-10-22T17:47:40Z</ns0:datestamp>"
        "<ns0:setSpec>com_10</ns0:setSpec><ns0:setSpec>col_11</ns0:setSpec></ns0:header>"
        f"<ns0:metadata>{body}</ns0:metadata></ns0:record></collection>"
    )
