"""Blocks and images from PDF, DOCX, PPTX and XLSX bytes, with the standard library alone.

Office files are zip archives of XML. The PDF reader covers simple files: Flate or plain content streams, literal
and hexadecimal strings in the usual one-byte encoding, JPEG and raw RGB or grey images; others give a typed error.
"""

from __future__ import annotations

import csv
import io
import posixpath
import re
import struct
import zipfile
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from xml.etree import ElementTree

PLACEHOLDER = '<IMAGE_REFERENCE src="{url}" page="{page}" index="{index}"></IMAGE_REFERENCE>'
ROWS_PER_BLOCK = 50
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


@dataclass
class Extracted:
    """blocks: (page, section, text); images: (page, index, ext, bytes). url_of(page, index, ext) names an image's object."""

    url_of: Callable[[int, int, str], str]
    blocks: list[tuple[int, str, str]] = field(default_factory=list)
    images: list[tuple[int, int, str, bytes]] = field(default_factory=list)

    def image(self, page: int, index: int, ext: str, data: bytes) -> str:
        self.images.append((page, index, ext, data))
        return PLACEHOLDER.format(url=self.url_of(page, index, ext), page=page, index=index)


def _name(element) -> str:
    return element.tag.rpartition("}")[2]


def _all(element, name: str):
    return (e for e in element.iter() if _name(e) == name)


def _child(element, name: str):
    return next((e for e in element if _name(e) == name), None)


class _Package:
    """Parts of an office file and the relationships between them."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.zip.namelist())

    def xml(self, part: str):
        return ElementTree.fromstring(self.zip.read(part))

    def relations(self, part: str) -> dict[str, tuple[str, str]]:
        """id -> (type, part), in file order."""
        folder, _, base = part.rpartition("/")
        rels = f"{folder}/_rels/{base}.rels".lstrip("/")
        if rels not in self.names:
            return {}
        out = {}
        for r in self.xml(rels):
            if r.get("TargetMode") != "External":
                target = r.get("Target", "")
                out[r.get("Id")] = (r.get("Type", ""), target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target)))
        return out

    def content_type(self, part: str) -> str:
        types, ext = self.xml("[Content_Types].xml"), part.rpartition(".")[2].lower()
        for t in types:
            if _name(t) == "Override" and t.get("PartName", "").lstrip("/") == part:
                return t.get("ContentType", "")
        return next((t.get("ContentType", "") for t in types if _name(t) == "Default" and t.get("Extension", "").lower() == ext), "")


def _runs(paragraph, line_break: str = "\n") -> str:
    """Text of a paragraph's own runs, links and fields; what is drawn inside a run (text boxes) is not part of it."""
    marks, parts = {"tab": "\t", "br": line_break, "cr": line_break, "noBreakHyphen": "-"}, []
    for e in paragraph:
        name = _name(e)
        if name == "br":
            parts.append(line_break)
        elif name in ("r", "fld"):
            parts += [x.text or "" if _name(x) == "t" else marks.get(_name(x), "") for x in e]
        elif name == "hyperlink":
            parts.append(_runs(e, line_break))
    return "".join(parts)


def extract_docx(content: bytes, out: Extracted) -> None:
    """A block for each heading's section; table contents are not read; all images go to the last section."""
    package, main = _Package(content), "word/document.xml"
    styles = {}
    if "word/styles.xml" in package.names:
        for s in _all(package.xml("word/styles.xml"), "style"):
            key = next((v for k, v in s.attrib.items() if k.rpartition("}")[2] == "styleId"), None)
            name = _child(s, "name")
            styles[key] = next(iter(name.attrib.values()), "") if name is not None else ""
    section, page, lines = "section-1", 1, []
    body = next(_all(package.xml(main), "body"))
    for p in (e for e in body if _name(e) == "p"):
        text = _runs(p).strip()
        if not text:
            continue
        style = next((next(iter(e.attrib.values()), "") for e in _all(p, "pStyle")), "")
        if styles.get(style, style).lower().startswith("heading"):
            if lines:
                out.blocks.append((page, section, "\n".join(lines)))
                lines, page = [], page + 1
            section = text
        else:
            lines.append(text)
    number = 0
    for kind, part in package.relations(main).values():
        if "image" in kind:
            number += 1
            ext = (package.content_type(part).rpartition("/")[2] or "png").lower()
            lines.append(out.image(1, number, ext, package.zip.read(part)))
    if lines:
        out.blocks.append((page, section, "\n".join(lines)))


def _paragraphs(body) -> str:
    return "\n".join(_runs(p, "\x0b") for p in body if _name(p) == "p")


def extract_pptx(content: bytes, out: Extracted) -> None:
    """A block for each slide that has anything: top-level shapes in order, then the speaker notes."""
    package, main = _Package(content), "ppt/presentation.xml"
    relations = package.relations(main)
    slides = [relations[e.get(f"{_R}id")][1] for e in _all(package.xml(main), "sldId")]
    for number, part in enumerate(slides, 1):
        own, lines, index = package.relations(part), [], 0
        tree = next(_all(package.xml(part), "spTree"))
        for shape in tree:
            if _name(shape) == "sp" and (body := _child(shape, "txBody")) is not None and (text := _paragraphs(body).strip()):
                lines.append(text)
            if _name(shape) == "pic":
                index += 1
                target = own[next(_all(shape, "blip")).get(f"{_R}embed")][1]
                lines.append(out.image(number, index, (target.rpartition(".")[2] or "png").lower(), package.zip.read(target)))
        for kind, target in own.values():
            if kind.endswith("/notesSlide"):
                for shape in _all(package.xml(target), "sp"):
                    if any(e.get("type") == "body" for e in _all(shape, "ph")) and (body := _child(shape, "txBody")) is not None and (text := _paragraphs(body).strip()):
                        lines.append(f"<SPEAKER_NOTES>{text}</SPEAKER_NOTES>")
        if lines:
            out.blocks.append((number, f"slide-{number}", "\n".join(lines)))


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


#: Numbers of the built-in formats that show dates or times.
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def _date_styles(package: _Package) -> set[int]:
    """Numbers of the cell styles that show dates or times."""
    if "xl/styles.xml" not in package.names:
        return set()
    styles = package.xml("xl/styles.xml")
    own = {int(f.get("numFmtId")): re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", f.get("formatCode", "")) for f in _all(styles, "numFmt")}
    dated = _DATE_FORMATS | {k for k, code in own.items() if re.search("[dmyhs]", code, re.I)}
    formats = _child(styles, "cellXfs")
    return {k for k, f in enumerate(formats if formats is not None else []) if int(f.get("numFmtId", 0)) in dated}


def _moment(days: float):
    """Date and time of a serial number of days; a time alone below 1."""
    moment = datetime(1899, 12, 30) + timedelta(seconds=round(days * 86400))
    return moment.time() if days < 1 else moment


def _sheet_rows(sheet, shared: list[str], dated: set[int]) -> list[list]:
    rows = []
    for r in _all(sheet, "row"):
        cells: list = []
        for c in (e for e in r if _name(e) == "c"):
            at = _column(c.get("r")) if c.get("r") else len(cells)
            cells += [None] * (at + 1 - len(cells))
            kind, value = c.get("t"), _child(c, "v")
            if kind == "inlineStr":
                cells[at] = "".join(e.text or "" for e in _all(c, "t"))
            elif value is not None and value.text is not None:
                if kind == "s":
                    cells[at] = shared[int(value.text)]
                elif kind == "b":
                    cells[at] = value.text == "1"
                elif kind in ("str", "e"):
                    cells[at] = value.text
                else:
                    number = float(value.text)
                    cells[at] = _moment(number) if int(c.get("s", 0)) in dated else int(number) if number.is_integer() else number
        rows.append(cells)
    return rows


def _distinct(header: list) -> list:
    """Names with .1, .2 and so on after those that have been there."""
    seen, out = {}, []
    for name in header:
        n = seen.get(name, 0)
        seen[name] = n + 1
        out.append(f"{name}.{n}" if n else name)
    return out


def table_text(header: list, rows: list[list]) -> str:
    """A table block: CSV with the header, stripped."""
    buffer = io.StringIO()
    csv.writer(buffer, lineterminator="\n").writerows([header, *rows])
    return f"<TABLE_REFERENCE>\n{buffer.getvalue().strip()}\n</TABLE_REFERENCE>"


def extract_xlsx(content: bytes, out: Extracted) -> None:
    """A block for each 50 data rows of each sheet, with the header; then one for each image."""
    package, main = _Package(content), "xl/workbook.xml"
    shared = ["".join(t.text or "" for t in _all(si, "t")) for si in _all(package.xml("xl/sharedStrings.xml"), "si")] if "xl/sharedStrings.xml" in package.names else []
    relations = package.relations(main)
    sheets = [(s.get("name"), relations[s.get(f"{_R}id")][1]) for s in _all(package.xml(main), "sheet")]
    dated = _date_styles(package)
    for page, (name, part) in enumerate(sheets, 1):
        rows = _sheet_rows(package.xml(part), shared, dated)
        if not rows:
            continue
        width = max(map(len, rows))
        blank = lambda r: ["" if v is None else v for v in [*r, *[None] * (width - len(r))]]
        header = _distinct([f"Unnamed: {k}" if v == "" else v for k, v in enumerate(blank(rows[0]))])
        data = [blank(r) for r in rows[1:]]
        for start in range(0, len(data), ROWS_PER_BLOCK):
            some = data[start : start + ROWS_PER_BLOCK]
            out.blocks.append((page, f"{name}:rows-{start + 1}-{start + len(some)}", table_text(header, some)))
    for page, (name, part) in enumerate(sheets, 1):
        index = 0
        for kind, drawing in package.relations(part).values():
            if kind.endswith("/drawing"):
                own = package.relations(drawing)
                for blip in _all(package.xml(drawing), "blip"):
                    index += 1
                    target = own.get(blip.get(f"{_R}embed"), ("", ""))[1]
                    data = package.zip.read(target) if target in package.names else b""
                    if data:  # a missing image still uses up its number
                        out.blocks.append((page, f"{name}:image-{index}", out.image(page, index, "png", data)))


_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.S)


def _png(width: int, height: int, channels: int, raw: bytes) -> bytes:
    row = width * channels
    lines = b"".join(b"\0" + raw[k * row : (k + 1) * row] for k in range(height))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2 if channels == 3 else 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


class _Pdf:
    def __init__(self, content: bytes):
        if not content.lstrip()[:5] == b"%PDF-":
            raise ValueError("not a PDF file")
        self.objects = {int(m[1]): m[3] for m in _OBJECT.finditer(content)}
        for o in [o for o in self.objects.values() if re.search(rb"/Type\s*/ObjStm\b", o.partition(b"stream")[0])]:
            head, body = self.stream(o)
            n, first = (int(re.search(rb"/" + k + rb"\s+(\d+)", head)[1]) for k in (b"N", b"First"))
            numbers = list(map(int, body[:first].split()))[: 2 * n]
            starts = [first + at for at in numbers[1::2]]
            for number, a, b in zip(numbers[0::2], starts, [*starts[1:], len(body)]):
                self.objects.setdefault(number, body[a:b])
        if not self.objects:
            raise NotImplementedError("PDF without plain objects")

    def refs(self, data: bytes, key: bytes) -> list[int]:
        m = re.search(rb"/" + key + rb"\s*(\[.*?\]|\d+\s+\d+\s+R)", data, re.S)
        return [int(x) for x in re.findall(rb"(\d+)\s+\d+\s+R", m[1])] if m else []

    def stream(self, data: bytes) -> tuple[bytes, bytes]:
        """(dictionary, decoded bytes); image filters are left as they are."""
        head, _, rest = data.partition(b"stream")
        body = rest[2:] if rest.startswith(b"\r\n") else rest[1:]
        body = body[: body.rindex(b"endstream")]
        if b"/FlateDecode" in head:
            body = zlib.decompressobj().decompress(body)
        elif b"/Filter" in head and b"/DCTDecode" not in head:
            raise NotImplementedError("PDF stream filter")
        return head, body

    def pages(self):
        root = next((o for o in self.objects.values() if re.search(rb"/Type\s*/Catalog\b", o)), None)
        if root is None:
            raise NotImplementedError("PDF without a plain catalog")
        todo = self.refs(root, b"Pages")
        while todo:
            o = self.objects[todo.pop(0)]
            if re.search(rb"/Type\s*/Pages\b", o):
                todo = self.refs(o, b"Kids") + todo
            else:
                yield o

    def text(self, page: bytes) -> str:
        parts = []
        for ref in self.refs(page, b"Contents"):
            parts.append(_shown(self.stream(self.objects[ref])[1]))
        return "\n".join(p for p in parts if p).strip()

    def images(self, page: bytes):
        """(ext, bytes) of the page's image objects, in the order of its resources."""
        found = re.search(rb"/XObject\s*<<(.*?)>>", page, re.S)
        if not found:
            for holder in [page, *(self.objects[r] for r in self.refs(page, b"Parent"))]:  # resources can be the parent's
                found = found or re.search(rb"/XObject\s*<<(.*?)>>", holder, re.S)
                for ref in self.refs(holder, b"Resources"):
                    found = found or re.search(rb"/XObject\s*<<(.*?)>>", self.objects[ref], re.S)
        for ref in re.findall(rb"(\d+)\s+\d+\s+R", found[1]) if found else []:
            o = self.objects[int(ref)]
            if not re.search(rb"/Subtype\s*/Image\b", o):
                continue
            head, body = self.stream(o)
            if b"/DCTDecode" in head:
                yield "jpeg", body
                continue
            width, height = (int(re.search(rb"/" + k + rb"\s+(\d+)", head)[1]) for k in (b"Width", b"Height"))
            yield "png", _png(width, height, 3 if b"/DeviceRGB" in head else 1, body)


_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
_TOKEN = re.compile(rb"\((?:\\.|[^\\()])*\)|<[0-9A-Fa-f\s]*>|\[|\]|[^\s\[\]()<>/]+|/[^\s\[\]()<>/]*", re.S)


def _string(token: bytes) -> str:
    if token[:1] == b"<":
        h = re.sub(rb"\s", b"", token[1:-1])
        return bytes.fromhex((h + b"0" * (len(h) % 2)).decode()).decode("cp1252", "replace")
    body = re.sub(rb"\\([0-7]{1,3}|.)", lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1] in b"01234567" else _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.S)
    return body.decode("cp1252", "replace")


def _shown(stream: bytes) -> str:
    """Text that a content stream shows: operators that move to another line end one."""
    lines, current, operands = [], "", []
    for t in _TOKEN.findall(stream):
        if t[:1] in (b"(", b"<"):
            operands.append(_string(t))
        elif t in (b"Tj", b"TJ"):
            current, operands = current + "".join(operands), []
        elif t in (b"Td", b"TD", b"T*", b"'", b'"', b"Tm", b"ET"):
            if current:
                lines.append(current)
            current = "".join(operands) if t in (b"'", b'"') else ""
            operands = []
        elif re.fullmatch(rb"[A-Za-z*]+", t):
            operands = []
    return "\n".join([*lines, current] if current else lines)


def extract_pdf(content: bytes, out: Extracted) -> None:
    """A block for each page that has text or images; images follow the text, one a line."""
    pdf = _Pdf(content)
    for number, page in enumerate(pdf.pages(), 1):
        marks = [out.image(number, k, ext, data) for k, (ext, data) in enumerate(pdf.images(page), 1)]
        text = "\n".join([pdf.text(page), *marks]).strip()
        if text:
            out.blocks.append((number, f"page-{number}", text))


EXTRACTORS = {"PDF": extract_pdf, "DOCX": extract_docx, "PPT": extract_pptx, "EXCEL": extract_xlsx}
