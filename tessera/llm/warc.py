"""WARC derivative builder: response records to metadata and plain-text conversion records.

Each response gives a metadata record (application/warc-fields: the status line, the source's HTTP
headers, its payload digest, title and links) and a conversion record (text/plain). Both refer to the
response by its record id, carry its target URI and date, and have block digests of their own; a
derivative's id is a name-based UUID of the response's id, so a rerun makes the same records.

Files are written by the text sink, whose line separator is the blank lines that end a record; so any
store that Spark writes will do, and a retried task leaves no half a file.

The conversion is of the body as the server meant it: chunks are joined, gzip and deflate unpacked. A body whose
header states chunks or a coding that it does not have (archives often store it decoded) is taken as it stands, with a
field that says so; of one that breaks off, what can be unpacked is. Other codings (br, zstd), bodies that unpack to more than
MOST bytes and types that are not text give no conversion record, and a field `no-conversion` with the reason. Pages of
HTML and XML give their visible text, other texts give their characters as they are. Digests are of the payload as
stored; `payload-digest-agrees` also accepts one of the joined chunks, which is what some archives state.

Defined results: a null html is an empty payload, a null URL leaves out the target URI; a record that
is not a well-formed response of HTTP gives a metadata record with the field "error" and no conversion
record; a charset that is unknown or cannot be decoded with is taken as UTF-8; a body without a Content-Type is a
page, unless a zero byte is among its first 1,024; repeated rows give equal records; an empty table gives no rows.
Columns besides the record are carried unchanged in `row`.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = b"\r\n\r\n"
#: Bytes that a body may unpack to.
MOST = 256 << 20
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_HIDDEN = {"script", "style", "noscript", "template"}
#: Elements that begin a line of their own.
_BLOCK = set(
    "p div br h1 h2 h3 h4 h5 h6 li ul ol tr td th table article section header footer nav main aside "
    "blockquote pre title head body html form dl dt dd hr".split()
)
#: The start of a comment, or a tag with its name; only looked for in front of a page's last ">", so that every
#: tag it begins to read has an end.
_TAG = re.compile(r"<(?:(!--)|(/?[A-Za-z]\w*|!)[^>]*>)", re.A)
_HREF = re.compile(r"\bhref\s*=\s*", re.A)
_WORD = re.compile(r"[^\s>]+")
_GAP = re.compile(r"[ \t\r\f\v\xa0]+")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def digest(b: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()


def name_id(text: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, text)}>"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record without the blank lines that end it."""
    head = [("WARC-Type", ""), *fields] if not any(k == "WARC-Type" for k, _ in fields) else fields
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in head), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + END + block


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(fields by lower-case name, block) of one record."""
    head, gap, rest = raw.partition(END)
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        k, colon, v = line.decode("utf-8", "replace").partition(":")
        if colon:
            fields.setdefault(k.strip().lower(), v.strip())
    n = int(fields.get("content-length", -1))
    if n < 0 or n > len(rest):
        raise ValueError("the block is not of the stated length")
    return fields, rest[:n]


def unpacked(content: bytes):
    """The content of a file by pieces: gzip members unpacked one after another, else whole."""
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    view, at, member = memoryview(content), 0, zlib.decompressobj(31)
    while at < len(view):
        if member.eof:
            member = zlib.decompressobj(31)
        piece = view[at : at + (1 << 20)]
        yield member.decompress(piece)
        at += len(piece) - len(member.unused_data)


def split_records(pieces):
    """The records of a WARC file that comes in pieces; one record at a time is held, and the piece it ends in."""
    held = b""
    for piece in pieces:
        held, at = held + piece, 0
        while (head := held.find(END, at)) >= 0:
            m = re.search(rb"(?im)^content-length:\s*(\d+)", held[at:head])
            if m is None:
                raise ValueError("a record without a length")
            end = head + len(END) + int(m[1])
            if end + len(END) > len(held):
                break
            yield held[at:end]
            at = end + len(END)
        held = held[at:]
    if held.strip():
        raise ValueError("the file ends inside a record")


class Page:
    """Title, links and visible text of a page, in one scan that goes on from every tag's end.

    A tag ends at the next ">"; a comment, a title and a hidden element at their end tags. What is not ended
    is not such an element: a page without a ">" behind some place has no tags from there on. Each kind of
    end is looked for once more only behind the last one found, and never again when there is none, so
    the scan is linear in the page.
    """

    def __init__(self, page: str):
        low = page.lower()
        self.page, self.low = page, low if len(low) == len(page) else page.translate(_LOWER)
        self.title: str | None = None
        self.links: list[str] = []
        self.absent: set[str] = set()
        out, at, last, search = [], 0, page.rfind(">") + 1, _TAG.search
        while tag := search(page, at, last):
            start, end = tag.span()
            out.append(page[at:start])
            name = tag[2]
            if name is None:
                if (end := self.find("-->", end)) >= 0:
                    out.append(" ")
                    at = end + 3
                else:
                    at = page.find(">", start) + 1
                continue
            at, name = end, name.lower()
            if name in _HIDDEN:
                if after := self.close(name, at):
                    out.append(" ")
                    at = after[1]
            elif name == "a":
                self.link(start, end - 1)
            elif (name[1:] if name[0] == "/" else name) in _BLOCK:
                out.append("\n")
                if name == "title" and self.title is None and (after := self.close(name, at)):
                    self.title = page[at : after[0]]
        out.append(page[at:])
        lines = (_GAP.sub(" ", x).strip() for x in entities.unescape("".join(out)).split("\n"))
        self.text = "\n".join(x for x in lines if x)

    def find(self, what: str, at: int) -> int:
        if what in self.absent:
            return -1
        if (found := self.low.find(what, at)) < 0:
            self.absent.add(what)
        return found

    def close(self, name: str, at: int) -> tuple[int, int] | None:
        """Start and end of the next end tag of that name."""
        while (tag := self.find(f"</{name}", at)) >= 0:
            at = tag + 2 + len(name)
            while self.low[at : at + 1].isspace():
                at += 1
            if self.low[at : at + 1] == ">":
                return tag, at + 1
        self.absent.add(f"</{name}")
        return None

    def link(self, tag: int, end: int) -> None:
        if (found := _HREF.search(self.low, tag + 2, end)) is None:
            return
        at, quote = found.end(), self.low[found.end() : found.end() + 1]
        if quote in ("'", '"') and (close := self.find(quote, at + 1)) >= 0:
            self.links.append(self.page[at + 1 : close])
        elif word := _WORD.match(self.page, at):
            self.links.append(word[0])


def text_of(page: str) -> str:
    """Visible text: a line for each block, white space folded."""
    return Page(page).text


def response_of(url: str | None, page: str | None, date: str = "2024-01-01T00:00:00Z") -> bytes:
    """A response record of a page, for tables that hold no raw records."""
    payload = (page or "").encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + END + payload
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", name_id(f"{url}\n{digest(payload)}")), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\r\n]", "", url)))
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block))]
    return record(fields, block)


def joined_chunks(body: bytes) -> bytes | None:
    """The body behind Transfer-Encoding: chunked, or None if it is not in chunks. Extensions and trailers go."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        n, at = int(size, 16), end + 2
        if n == 0:
            return b"".join(parts)
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        parts.append(body[at : at + n])
        at += n + 2


def inflated(body: bytes, coding: str) -> tuple[bytes | None, str]:
    """(the body unpacked, "" or what is wrong with it); None if it is too large."""
    for bits in (31,) if "gzip" in coding else (15, -15):  # deflate: with a zlib header, or without one
        out, size, left = [], 0, body
        unpack = zlib.decompressobj(bits)
        try:
            while left:
                out.append(unpack.decompress(left, 1 << 20))
                size += len(out[-1])
                if size > MOST:
                    return None, f"it unpacks to more than {MOST} bytes"
                left = unpack.unconsumed_tail
                if unpack.eof:
                    left = unpack.unused_data if bits == 31 and unpack.unused_data[:2] == b"\x1f\x8b" else b""
                    if left:
                        unpack = zlib.decompressobj(bits)
                elif not left:  # what the last call held back
                    while piece := unpack.decompress(b"", 1 << 20):
                        out.append(piece)
                        size += len(piece)
            return b"".join(out), "" if unpack.eof or not body else f"{coding} breaks off"
        except zlib.error:
            if size:
                return b"".join(out), f"{coding} breaks off"
    return body, f"not {coding}"


def decoded(headers: list[tuple[str, str]], payload: bytes) -> tuple[bytes | None, bytes, list[tuple[str, str]], str]:
    """(body or None, the payload with its chunks joined, fields on what was odd, why there is no body)."""
    stated = lambda name: [x.strip().lower() for k, v in headers if k.strip().lower() == name for x in v.split(",") if x.strip()]
    body, said = payload, []
    if "chunked" in stated("transfer-encoding"):
        if (found := joined_chunks(body)) is None:
            said.append(("transfer-encoding-error", "not in chunks"))
        else:
            body = found
    entity = body
    codings = [x for x in stated("content-encoding") + [x for x in stated("transfer-encoding") if x != "chunked"] if x != "identity"]
    for coding in reversed(codings):
        if coding not in ("gzip", "x-gzip", "deflate"):
            return None, entity, said, f"content-encoding {coding}"
        body, wrong = inflated(body, coding)
        if body is None:
            return None, entity, said, wrong
        if wrong:
            said.append(("content-encoding-error", wrong))
    return body, entity, said, ""


def media_type(headers: list[tuple[str, str]], body: bytes) -> tuple[str, str]:
    """("page", "text" or "", the type): how a body of this type is read, "" if it is no text."""
    stated = next((v for k, v in headers if k.strip().lower() == "content-type"), "").split(";")[0].strip().lower()
    if not stated:
        return ("", "unknown") if b"\0" in body[:1024] else ("page", "unknown")
    if stated in ("text/html", "text/xml", "application/xml") or stated.endswith("+xml") and not stated.startswith("image/"):
        return "page", stated
    plain = stated.startswith("text/") or stated.endswith("+json") or stated in ("application/json", "application/javascript", "application/x-javascript")
    return ("text" if plain else ""), stated


def derive(raw: bytes | None) -> list[dict]:
    """The derivatives of a response record: dicts of record_type, record_id, refers_to, target_uri,
    block_digest, source_digest, text (conversion only) and record."""
    raw, error = raw or b"", None
    fields: dict[str, str] = {}
    status, headers, payload = "", [], b""
    try:
        fields, block = parse(raw)
        if fields.get("warc-type") != "response":
            raise ValueError("not a response")
        head, gap, payload = block.partition(END)
        first, *rest = head.decode("utf-8", "replace").split("\r\n")
        if not gap or not first.startswith("HTTP/"):
            raise ValueError("not a message of HTTP")
        status, headers = first, [tuple(x.split(":", 1)) for x in rest if ":" in x]
    except ValueError as e:
        error = str(e)
    refers = fields.get("warc-record-id") or name_id(digest(raw))
    stated, found = fields.get("warc-payload-digest"), digest(payload)
    shared = [("WARC-Refers-To", refers), ("WARC-Date", fields.get("warc-date", "1970-01-01T00:00:00Z"))]
    shared += [("WARC-Target-URI", fields["warc-target-uri"]), ("WARC-Refers-To-Target-URI", fields["warc-target-uri"])] if fields.get("warc-target-uri") else []
    shared += [("WARC-Refers-To-Date", fields["warc-date"])] if fields.get("warc-date") else []

    def made(kind: str, content_type: str, block: bytes, text: str | None) -> dict:
        own = [("WARC-Type", kind), ("WARC-Record-ID", name_id(f"{refers}\n{kind}")), *shared, ("Content-Type", content_type), ("WARC-Block-Digest", digest(block))]
        return {"record_type": kind, "record_id": own[1][1], "refers_to": refers, "target_uri": fields.get("warc-target-uri"), "block_digest": own[-1][1], "source_digest": stated or found, "text": text, "record": record(own, block)}

    one_line = lambda s: re.sub(r"\s+", " ", s).strip()
    meta = [("error", error)] if error else []
    if error:
        return [made("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in meta).encode(), None)]
    body, entity, odd, missing = decoded(headers, payload)
    read, kind = media_type(headers, body or b"")
    if not missing and not read:
        missing = f"content-type {kind}"
    agrees = str(stated in (None, found, digest(entity))).lower()
    meta += [("http-status", status), *((f"http-header-{k.strip().lower()}", one_line(v)) for k, v in headers), ("payload-digest", found), ("payload-digest-agrees", agrees), *odd]
    lines = lambda: "".join(f"{k}: {v}\r\n" for k, v in meta).encode()
    if missing:
        meta.append(("no-conversion", one_line(missing)))
        return [made("metadata", "application/warc-fields", lines(), None)]
    charset = _CHARSET.search(next((v for k, v in headers if k.strip().lower() == "content-type"), ""))
    if charset is None and read == "page":
        charset = _CHARSET.search(body[:1024].decode("latin-1"))
    try:
        text = body.decode(charset[1] if charset else "utf-8", "replace")
    except (LookupError, UnicodeError):
        text = body.decode("utf-8", "replace")
    if read == "page":
        seen = Page(text)
        meta += [("title", one_line(text_of(seen.title)))] if seen.title is not None else []
        meta += [("outlink", one_line(entities.unescape(x))) for x in seen.links]
        text = seen.text
    return [
        made("metadata", "application/warc-fields", lines(), None),
        made("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace"), text),
    ]


_FIELDS = "record_type string, record_id string, refers_to string, target_uri string, block_digest string, source_digest string, text string, record binary"


def responses(url: Column, html: Column) -> Column:
    """Response records of the pages of a table."""
    return F.arrow_udf(lambda u, h: pa.array([response_of(a, b) for a, b in zip(u.to_pylist(), h.to_pylist())], pa.binary()), "binary")(url, html)


def derivatives(df: DataFrame, raw: str) -> DataFrame:
    """One row for each derivative of the response records in column `raw`: `row` holds the other
    columns of df as they came."""
    kind = pa.list_(pa.struct([(x.split()[0], pa.binary() if x.endswith("binary") else pa.string()) for x in _FIELDS.split(", ")]))
    made = F.arrow_udf(lambda x: pa.array([derive(v) for v in x.to_pylist()], kind), f"array<struct<{_FIELDS.replace(' ', ': ').replace(',: ', ', ')}>>")
    rest = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != raw]).alias("row")
    return df.select(rest, F.explode(made(F.col(f"`{raw}`"))).alias("d")).select("row", "d.*")


def write(records: DataFrame, folder: str, column: str = "record") -> None:
    """WARC files of a binary column of records, one file a task."""
    records.select(F.col(f"`{column}`").cast("string")).write.option("lineSep", END.decode()).text(folder)


def read(spark: SparkSession, folder: str, files: str = "part-*") -> DataFrame:
    """(record) of every record in the WARC files of a folder, plain or in gzip members; a task holds a file
    as it is stored and one member of it at a time."""

    def run(batches):
        for batch in batches:
            for content in batch["content"]:
                found, size = [], 0
                for one in split_records(unpacked(content.as_py())):
                    found.append(one)
                    size += len(one)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])
                        found, size = [], 0
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["record"])

    return spark.read.format("binaryFile").load(f"{folder}/{files}").select("content").mapInArrow(run, "record binary")
