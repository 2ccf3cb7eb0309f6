"""Records of web archives, from the pieces between record marks."""

import gzip
import io
import re
from collections.abc import Iterable, Iterator

MARK = b"WARC/1."


def _headers(stream) -> dict[str, str] | None:
    out: dict[str, str] = {}
    while True:
        line = stream.readline()
        if not line:
            return None
        line = line.strip()
        if not line:
            return out
        name, _, value = line.partition(b":")
        out[name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()


def records(pieces: Iterable[tuple[object, bytes]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of the records of ``(file, piece)``, pieces of a file being in order.

    What precedes the first mark of a file is no record. A body that holds the mark is put together
    again by its declared length; one that ends early is dropped.
    """
    held, head, need, last = b"", None, 0, None
    for file, piece in pieces:
        if file != last or head is None or len(held) >= need:
            if head is not None and len(held) >= need:
                yield head, held[:need]
            head, last = None, file
            stream = io.BytesIO(piece or b"")
            if not re.fullmatch(rb"\d\r?\n", stream.readline()):
                continue
            head = _headers(stream)
            if head is not None:
                held, need = stream.read(), int(head.get("content-length") or 0)
        else:
            held += MARK + (piece or b"")
    if head is not None and len(held) >= need:
        yield head, held[:need]


def responses(pieces: Iterable[tuple[object, bytes]]) -> Iterator[tuple[str, str, str]]:
    """(url, date, decoded body) of each response record."""
    for head, body in records(pieces):
        if head.get("warc-type") != "response":
            continue
        http = io.BytesIO(body)
        http.readline()
        fields = _headers(http) or {}
        raw = http.read()
        if fields.get("content-encoding", "").lower() == "gzip":
            try:
                raw = gzip.decompress(raw)
            except (OSError, EOFError):
                pass  # kept as it is
        found = re.search(r"charset=[\"']?([A-Za-z0-9._-]+)", fields.get("content-type", ""), re.I)
        try:
            text = raw.decode(found[1] if found else "utf-8", "replace")
        except LookupError:
            text = raw.decode("utf-8", "replace")
        yield head.get("warc-target-uri", "").strip("<>"), head.get("warc-date", ""), text
