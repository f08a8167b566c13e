"""Extractors on office files and PDFs that are made here."""

import io
import zipfile
import zlib

import pytest

from tarnwork.sources.extract import EXTRACTORS, Extracted

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
A = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
TYPES = '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="png" ContentType="image/png"/><Default Extension="xml" ContentType="application/xml"/></Types>'


def zipped(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in {"[Content_Types].xml": TYPES, **parts}.items():
            z.writestr(name, body)
    return out.getvalue()


def rels(*items):
    return "<Relationships>" + "".join(f'<Relationship Id="{i}" Type="{RELS}/{kind}" Target="{target}"/>' for i, kind, target in items) + "</Relationships>"


def docx(paragraphs, images=1):
    body = "".join(f'<w:p><w:pPr>{"<w:pStyle w:val=%s/>" % chr(34) .join(["", "Heading1", ""]) if h else ""}</w:pPr><w:r><w:t>{t}</w:t></w:r></w:p>' for h, t in paragraphs)
    return zipped({
        "word/document.xml": f"<w:document {W}><w:body>{body}<w:tbl><w:tr><w:tc><w:p><w:r><w:t>in a table</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>",
        "word/styles.xml": f'<w:styles {W}><w:style w:styleId="Heading1"><w:name w:val="heading 1"/></w:style></w:styles>',
        "word/_rels/document.xml.rels": rels(*[(f"r{k}", "image", f"media/i{k}.png") for k in range(images)]),
        **{f"word/media/i{k}.png": b"image" for k in range(images)},
    })


def pptx():
    slide = lambda shapes: f"<p:sld {A}><p:cSld><p:spTree>{shapes}</p:spTree></p:cSld></p:sld>"
    box = lambda t, ph="": f'<p:sp><p:nvSpPr><p:nvPr>{ph}</p:nvPr></p:nvSpPr><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sp>'
    return zipped({
        "ppt/presentation.xml": f'<p:presentation {A}><p:sldIdLst><p:sldId r:id="a"/><p:sldId r:id="b"/><p:sldId r:id="c"/></p:sldIdLst></p:presentation>',
        "ppt/_rels/presentation.xml.rels": rels(("a", "slide", "slides/s1.xml"), ("b", "slide", "slides/s2.xml"), ("c", "slide", "slides/s3.xml")),
        "ppt/slides/s1.xml": slide(box("Title") + f"<p:grpSp>{box('grouped')}</p:grpSp>"), "ppt/slides/s2.xml": slide(box(" ")),
        "ppt/slides/s3.xml": slide('<p:pic><p:blipFill><a:blip r:embed="i"/></p:blipFill></p:pic>'),
        "ppt/slides/_rels/s1.xml.rels": rels(("n", "notesSlide", "../notesSlides/n1.xml")), "ppt/slides/_rels/s3.xml.rels": rels(("i", "image", "../media/i.PNG")),
        "ppt/notesSlides/n1.xml": slide(box("1", '<p:ph type="sldNum"/>') + box("Say this ", '<p:ph type="body"/>')), "ppt/media/i.PNG": b"image",
    })


def xlsx(rows=120):
    cell = lambda r, c, v: f'<c r="{c}{r}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{c}{r}"><v>{v}</v></c>'
    data = f'<row r="1">{cell(1, "A", "id")}{cell(1, "B", "name")}</row>' + "".join(f'<row r="{k + 1}">{cell(k + 1, "A", k)}{cell(k + 1, "B", f"n,{k}") if k % 2 else ""}</row>' for k in range(1, rows + 1))
    return zipped({
        "xl/workbook.xml": f'<workbook xmlns:r="{RELS}"><sheets><sheet name="S" r:id="a"/><sheet name="Empty" r:id="b"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": rels(("a", "worksheet", "worksheets/s1.xml"), ("b", "worksheet", "worksheets/s2.xml")),
        "xl/worksheets/s1.xml": f"<worksheet><sheetData>{data}</sheetData></worksheet>", "xl/worksheets/s2.xml": f'<worksheet><sheetData><row r="1">{cell(1, "A", "only")}</row></sheetData></worksheet>',
        "xl/worksheets/_rels/s1.xml.rels": rels(("d", "drawing", "../drawings/d.xml")), "xl/drawings/_rels/d.xml.rels": rels(("gone", "image", "../media/none.png"), ("i", "image", "../media/i.png")),
        "xl/drawings/d.xml": f'<x {A}><a:blip r:embed="gone"/><a:blip r:embed="i"/></x>', "xl/media/i.png": b"image",
    })


def pdf(pages, compress=True):
    """pages: (text lines, with an image)."""
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [" + b" ".join(b"%d 0 R" % (10 + 10 * k) for k in range(len(pages))) + b"] /Count %d >>" % len(pages)}
    for k, (lines, image) in enumerate(pages):
        at = 10 + 10 * k
        body = b"BT /F1 12 Tf 72 700 Td " + b" 0 -14 Td ".join(b"(" + t.encode("cp1252").replace(b"(", b"\\(").replace(b")", b"\\)") + b") Tj" for t in lines) + b" ET"
        packed = zlib.compress(body) if compress else body
        objects[at] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R /Resources << " % (at + 1) + (b"/XObject << /Im0 %d 0 R >> " % (at + 2) if image else b"") + b">> >>"
        objects[at + 1] = b"<< /Length %d%s >>\nstream\n" % (len(packed), b" /Filter /FlateDecode" if compress else b"") + packed + b"\nendstream"
        if image:
            raw = zlib.compress(b"\xff\0\0" * 4)
            objects[at + 2] = b"<< /Subtype /Image /Width 2 /Height 2 /ColorSpace /DeviceRGB /BitsPerComponent 8 /Filter /FlateDecode /Length %d >>\nstream\n" % len(raw) + raw + b"\nendstream"
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n" % n + o + b"\nendobj\n" for n, o in objects.items()) + b"trailer << /Root 1 0 R >>\n%%EOF"


def extracted(kind, content):
    out = Extracted(lambda page, index, ext: f"u/{page}_{index}.{ext}")
    EXTRACTORS[kind](content, out)
    return out


def mark(page, index, ext="png"):
    return f'<IMAGE_REFERENCE src="u/{page}_{index}.{ext}" page="{page}" index="{index}"></IMAGE_REFERENCE>'


def test_docx():
    out = extracted("DOCX", docx([(0, "intro"), (1, "A"), (0, "a1"), (0, " "), (0, "a2"), (1, "B"), (1, "C"), (0, "c1")]))
    assert out.blocks == [(1, "section-1", "intro"), (2, "A", "a1\na2"), (3, "C", "c1\n" + mark(1, 1))]
    assert extracted("DOCX", docx([(0, "x"), (1, "End")], 0)).blocks == [(1, "section-1", "x")]


def test_pptx():
    out = extracted("PPT", pptx())
    assert out.blocks == [(1, "slide-1", "Title\n<SPEAKER_NOTES>Say this</SPEAKER_NOTES>"), (3, "slide-3", mark(3, 1))] and out.images == [(3, 1, "png", b"image")]


def test_xlsx():
    out = extracted("EXCEL", xlsx())
    assert [b[1] for b in out.blocks] == ["S:rows-1-50", "S:rows-51-100", "S:rows-101-120", "S:image-2"]
    assert out.blocks[2][2].startswith('<TABLE_REFERENCE>\nid,name\n101,"n,101"\n102,\n') and out.blocks[0][2].endswith("\n50,\n</TABLE_REFERENCE>") and out.blocks[3][2] == mark(1, 2)


@pytest.mark.parametrize("compress", [True, False])
def test_pdf(compress):
    out = extracted("PDF", pdf([(["Hello (you)", "second line"], True), ([], False), (["Third"], False)], compress))
    assert out.blocks == [(1, "page-1", "Hello (you)\nsecond line\n" + mark(1, 1)), (3, "page-3", "Third")]
    assert out.images[0][3].startswith(b"\x89PNG")


def test_bad_files():
    with pytest.raises(ValueError):
        extracted("PDF", b"no pdf")
    with pytest.raises(zipfile.BadZipFile):
        extracted("DOCX", b"no zip")


def test_word_runs_and_shape_breaks():
    body = '<w:p><w:pPr><w:tabs><w:tab/></w:tabs></w:pPr><w:r><w:t>a</w:t><w:tab/><w:t>b</w:t><w:br/></w:r><w:hyperlink><w:r><w:t>link</w:t></w:r></w:hyperlink><w:r><w:drawing><w:t>box</w:t></w:drawing></w:r></w:p>'
    assert extracted("DOCX", zipped({"word/document.xml": f"<w:document {W}><w:body>{body}</w:body></w:document>"})).blocks == [(1, "section-1", "a\tb\nlink")]
    slide = f"<p:sld {A}><p:cSld><p:spTree><p:sp><p:txBody><a:p><a:r><a:t>a</a:t></a:r><a:br/><a:fld><a:t>7</a:t></a:fld></a:p><a:p/></p:txBody></p:sp></p:spTree></p:cSld></p:sld>"
    deck = {"ppt/presentation.xml": f'<p:presentation {A}><p:sldIdLst><p:sldId r:id="a"/></p:sldIdLst></p:presentation>', "ppt/_rels/presentation.xml.rels": rels(("a", "slide", "slides/s1.xml")), "ppt/slides/s1.xml": slide}
    assert extracted("PPT", zipped(deck)).blocks == [(1, "slide-1", "a\x0b7")]


def test_dates_and_repeated_headers():
    rows = '<row r="1"><c r="A1" t="inlineStr"><is><t>x</t></is></c><c r="B1" t="inlineStr"><is><t>x</t></is></c><c r="D1" t="inlineStr"><is><t>y</t></is></c></row><row r="2"><c r="A2" s="1"><v>45292.5</v></c><c r="B2" s="2"><v>0.25</v></c><c r="D2" s="3"><v>1.5</v></c></row>'
    book = {
        "xl/workbook.xml": f'<workbook xmlns:r="{RELS}"><sheets><sheet name="S" r:id="a"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": rels(("a", "worksheet", "worksheets/s1.xml")), "xl/worksheets/s1.xml": f"<worksheet><sheetData>{rows}</sheetData></worksheet>",
        "xl/styles.xml": '<styleSheet><numFmts><numFmt numFmtId="164" formatCode="hh:mm"/><numFmt numFmtId="165" formatCode="0.0&quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>',
    }
    assert extracted("EXCEL", zipped(book)).blocks == [(1, "S:rows-1-1", "<TABLE_REFERENCE>\nx,x.1,Unnamed: 2,y\n2024-01-01 12:00:00,06:00:00,,1.5\n</TABLE_REFERENCE>")]


def test_pdf_object_streams():
    inner = [(1, b"<< /Type /Catalog /Pages 2 0 R >>"), (2, b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>"), (3, b"<< /Type /Page /Parent 2 0 R /Contents 5 0 R >>")]
    head, body = b"", b""
    for n, o in inner:
        head += b"%d %d " % (n, len(body))
        body += o + b" "
    packed = zlib.compress(head + body)
    text = b"BT /F1 12 Tf (Hi) Tj T* <4869> Tj [(a) -200 (b)] TJ ET"
    file = b"%%PDF-1.5\n4 0 obj\n<< /Type /ObjStm /N 3 /First %d /Filter /FlateDecode >>\nstream\n" % len(head) + packed + b"\nendstream\nendobj\n5 0 obj\n<< /Length %d >>\nstream\n" % len(text) + text + b"\nendstream\nendobj\n"
    assert extracted("PDF", file).blocks == [(1, "page-1", "Hi\nHiab")]
