"""Small office files and PDFs from text, with the standard library: inputs for tests and queries, and exports."""

from __future__ import annotations

import io
import zipfile
import zlib
from xml.sax.saxutils import escape, quoteattr

_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_WORD = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
_DRAWING = f'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:r="{_RELATIONS}"'
_TYPES = '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="png" ContentType="image/png"/><Default Extension="xml" ContentType="application/xml"/></Types>'


def _zip(parts: dict[str, str | bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in {"[Content_Types].xml": _TYPES, **parts}.items():
            z.writestr(zipfile.ZipInfo(name, (2024, 1, 1, 0, 0, 0)), body)  # a fixed time, so that bytes are the same every time
    return out.getvalue()


def _relations(items: list[tuple[str, str, str]]) -> str:
    return '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="{i}" Type="{_RELATIONS}/{kind}" Target="{target}"/>' for i, kind, target in items) + "</Relationships>"


def docx(paragraphs: list[tuple[bool, str]], images: list[bytes] = ()) -> bytes:
    """paragraphs: (is a heading, text)."""
    body = "".join(f'<w:p>{"<w:pPr><w:pStyle w:val=%s/></w:pPr>" % quoteattr("Heading1") if h else ""}<w:r><w:t xml:space="preserve">{escape(t)}</w:t></w:r></w:p>' for h, t in paragraphs)
    return _zip({
        "word/document.xml": f"<w:document {_WORD}><w:body>{body}</w:body></w:document>",
        "word/styles.xml": f'<w:styles {_WORD}><w:style w:styleId="Heading1"><w:name w:val="heading 1"/></w:style></w:styles>',
        "word/_rels/document.xml.rels": _relations([(f"r{k}", "image", f"media/image{k}.png") for k in range(len(images))]),
        **{f"word/media/image{k}.png": data for k, data in enumerate(images)},
    })


def pptx(slides: list[tuple[list[str], str, list[bytes]]]) -> bytes:
    """slides: (texts of shapes, speaker notes, pictures)."""
    tree = lambda shapes: f"<p:sld {_DRAWING}><p:cSld><p:spTree>{shapes}</p:spTree></p:cSld></p:sld>"
    box = lambda t, ph="": f"<p:sp><p:nvSpPr><p:nvPr>{ph}</p:nvPr></p:nvSpPr><p:txBody><a:p><a:r><a:t>{escape(t)}</a:t></a:r></a:p></p:txBody></p:sp>"
    parts: dict[str, str | bytes] = {
        "ppt/presentation.xml": f"<p:presentation {_DRAWING}><p:sldIdLst>" + "".join(f'<p:sldId r:id="s{k}"/>' for k in range(len(slides))) + "</p:sldIdLst></p:presentation>",
        "ppt/_rels/presentation.xml.rels": _relations([(f"s{k}", "slide", f"slides/s{k}.xml") for k in range(len(slides))]),
    }
    for k, (texts, notes, pictures) in enumerate(slides):
        shapes = "".join(map(box, texts)) + "".join(f'<p:pic><p:blipFill><a:blip r:embed="i{j}"/></p:blipFill></p:pic>' for j in range(len(pictures)))
        parts[f"ppt/slides/s{k}.xml"] = tree(shapes)
        parts[f"ppt/slides/_rels/s{k}.xml.rels"] = _relations([*[("n", "notesSlide", f"../notesSlides/n{k}.xml")] * bool(notes), *((f"i{j}", "image", f"../media/s{k}_{j}.png") for j in range(len(pictures)))])
        if notes:
            parts[f"ppt/notesSlides/n{k}.xml"] = tree(box(notes, '<p:ph type="body"/>'))
        parts |= {f"ppt/media/s{k}_{j}.png": data for j, data in enumerate(pictures)}
    return _zip(parts)


def _column(k: int) -> str:
    return (_column(k // 26 - 1) if k >= 26 else "") + chr(65 + k % 26)


def xlsx(sheets: dict[str, list[list]]) -> bytes:
    """sheets: name to rows, the first of them the header."""
    def cell(r: int, c: int, v) -> str:
        at = f"{_column(c)}{r}"
        return "" if v is None else f'<c r="{at}"><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    names = list(sheets)
    parts = {
        "xl/workbook.xml": f'<workbook xmlns:r="{_RELATIONS}"><sheets>' + "".join(f'<sheet name={quoteattr(n)} r:id="s{k}"/>' for k, n in enumerate(names)) + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": _relations([(f"s{k}", "worksheet", f"worksheets/s{k}.xml") for k in range(len(names))]),
    }
    for k, n in enumerate(names):
        parts[f"xl/worksheets/s{k}.xml"] = "<worksheet><sheetData>" + "".join(f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>" for r, row in enumerate(sheets[n], 1)) + "</sheetData></worksheet>"
    return _zip(parts)


def pdf(pages: list[tuple[list[str], bool]], compress: bool = True) -> bytes:
    """pages: (lines, with a small red image)."""
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [" + b" ".join(b"%d 0 R" % (10 + 10 * k) for k in range(len(pages))) + b"] /Count %d >>" % len(pages)}
    flate = b" /Filter /FlateDecode" if compress else b""
    for k, (lines, image) in enumerate(pages):
        at = 10 + 10 * k
        shown = (b"(" + t.encode("cp1252", "replace").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)") + b") Tj" for t in lines)
        body = b"BT /F1 12 Tf 72 700 Td " + b" 0 -14 Td ".join(shown) + b" ET"
        packed = zlib.compress(body) if compress else body
        objects[at] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R /Resources << " % (at + 1) + (b"/XObject << /Im0 %d 0 R >> " % (at + 2) if image else b"") + b">> >>"
        objects[at + 1] = b"<< /Length %d%s >>\nstream\n" % (len(packed), flate) + packed + b"\nendstream"
        if image:
            raw = zlib.compress(b"\xff\0\0" * 4)
            objects[at + 2] = b"<< /Subtype /Image /Width 2 /Height 2 /ColorSpace /DeviceRGB /BitsPerComponent 8 /Filter /FlateDecode /Length %d >>\nstream\n" % len(raw) + raw + b"\nendstream"
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n" % n + o + b"\nendobj\n" for n, o in objects.items()) + b"trailer << /Root 1 0 R >>\n%%EOF"
