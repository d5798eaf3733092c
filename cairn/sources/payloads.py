"""Decoding of landed response payloads: compressed bytes to text, or to the records of an array that no memory holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FLUSH_BYTES = 4 * 1024 * 1024


def decode_payloads(df: DataFrame, payload: str = "payload", encoding: str = "content_encoding") -> DataFrame:
    """Adds ``text`` and ``decode_error``, dropping the payload.

    The declared encoding decides (gzip, or deflate with or without its zlib header); without
    one the leading bytes do. Bytes that do not decode give NULL text and the reason, so one
    broken payload does not end the job. Spark has no inflate function, hence the Arrow batches;
    text is handed over in slices, since a batch may grow a thousandfold when unpacked. Beside the batch that came, a
    worker holds one slice, or one text that is larger than that.
    """
    kept = [field for field in df.schema.fields if field.name != payload]
    schema = T.StructType(
        [*kept, T.StructField("text", T.StringType()), T.StructField("decode_error", T.StringType())]
    )
    kept_names, flush_bytes = [field.name for field in kept], FLUSH_BYTES

    # Nested, so that it travels to the executors by value and needs no package there.
    def decode_batches(batches):
        import zlib

        import pyarrow as pa

        piece = 1 << 20

        def windows(data, declared):
            """The zlib window settings to try: 31 reads gzip, 15 zlib, -15 bare deflate; none for plain bytes."""
            declared = (declared or "").lower()
            zlib_head = len(data) > 1 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0
            settings = {"gzip": [31], "deflate": [15, -15] if zlib_head else [-15]}
            guessed = [31] if data.startswith(b"\x1f\x8b") else [15] if data.startswith(b"\x78\x9c") else []
            return next((bits for name, bits in settings.items() if name in declared), guessed)

        def unpack(data, bits):
            out = []
            while data:
                engine = zlib.decompressobj(bits)
                for at in range(0, len(data), piece):
                    out.append(engine.decompress(data[at : at + piece]))
                    if engine.eof:
                        break
                if not engine.eof:
                    raise EOFError("compressed data ends early")
                # a gzip file may have several members, and zero bytes behind them
                data = (engine.unused_data + data[at + piece :]).lstrip(b"\0") if bits == 31 else b""
            return b"".join(out)

        def decode(data, declared):
            tried = windows(data, declared) if data else []
            for bits in tried:
                try:
                    return unpack(data, bits)
                except zlib.error:
                    if bits == tried[-1]:
                        raise
            return data or b""

        def text_of(data, declared):
            try:
                return decode(data, declared).decode("utf-8"), None
            except (OSError, EOFError, zlib.error, UnicodeDecodeError) as failure:
                return None, f"{type(failure).__name__}: {failure}"

        def slices(batch):
            start, size, texts, errors = 0, 0, [], []
            for data, declared in zip(batch.column(payload), batch.column(encoding)):
                text, error = text_of(data.as_py(), declared.as_py())
                texts.append(text)
                errors.append(error)
                size += len(text or "")
                if size >= flush_bytes:
                    yield start, texts, errors
                    start, size, texts, errors = start + len(texts), 0, [], []
            if texts:
                yield start, texts, errors

        for batch in batches:
            kept_columns = batch.select(kept_names)
            for start, texts, errors in slices(batch):
                columns = kept_columns.slice(start, len(texts)).columns
                added = [pa.array(texts, pa.string()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *added], [*kept_names, "text", "decode_error"])

    return df.mapInArrow(decode_batches, schema)


PIECE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
MAX_RECORD_BYTES = 1 << 30


def array_records(df: DataFrame, payload: str = "payload", encoding: str = "content_encoding", max_record: int = MAX_RECORD_BYTES) -> DataFrame:
    """One row for each element of the array that a payload holds: ``record``, beside the other columns.

    The payload is inflated a megabyte at a time and cut at the commas between its elements as they come, so a worker
    holds the compressed bytes, one element and one batch, however large the array is. It is read twice: first to its
    end, so that a payload that does not decode, or is no whole array, is one record that says why (or holds its text, where
    that is short), and not half an array. Text elements come without quotes and null ones as NULL. An empty body
    is one empty record; no element may be larger than ``max_record`` bytes.
    """
    kept = [field for field in df.schema.fields if field.name != payload]
    schema = T.StructType([*kept, T.StructField("record", T.StringType())])
    return df.mapInArrow(_array_cutter([field.name for field in kept], payload, encoding, max_record), schema)


def _array_cutter(kept_names: list[str], payload: str, encoding: str, max_record: int = MAX_RECORD_BYTES):
    piece_bytes, batch_bytes = PIECE_BYTES, BATCH_BYTES

    # Nested, so that it travels to the executors by value and needs no package there.
    def cut_batches(batches):
        import json
        import re
        import zlib

        import pyarrow as pa

        # what changes the state outside a string, and inside one
        outside, deeper, inside = re.compile(rb'["\[\]{},]'), re.compile(rb'["\[\]{}]'), re.compile(rb'["\\]')
        blank = b" \t\r\n"

        def settings(data, declared):
            """The zlib window settings to try: 31 reads gzip, 15 zlib, -15 bare deflate; None reads plain bytes."""
            declared = (declared or "").lower()
            zlib_head = len(data) > 1 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0
            guessed = [31] if data.startswith(b"\x1f\x8b") else [15] if data.startswith(b"\x78\x9c") else [None]
            known = {"gzip": [31], "deflate": [15, -15] if zlib_head else [-15]}
            return next((tried for name, tried in known.items() if name in declared), guessed) if data else [None]

        def pieces(data, bits):
            """The inflated bytes, at most ``piece_bytes`` at a time."""
            view = memoryview(data)
            if bits is None:
                for at in range(0, len(view), piece_bytes):
                    yield bytes(view[at : at + piece_bytes])
                return
            at = 0
            while at < len(view):
                engine = zlib.decompressobj(bits)
                while not engine.eof:
                    fed = engine.unconsumed_tail or bytes(view[at : at + piece_bytes])
                    if not engine.unconsumed_tail:
                        at += len(fed)
                    if not fed:
                        # all is fed; what the engine still holds comes out, or the data ends early
                        rest = engine.decompress(b"", piece_bytes)
                        if not rest and not engine.eof:
                            raise EOFError("compressed data ends early")
                        yield rest
                        continue
                    yield engine.decompress(fed, piece_bytes)
                at -= len(engine.unused_data)
                if bits != 31:
                    return
                # a gzip file may have several members, and zero bytes behind them
                while at < len(view) and view[at] == 0:
                    at += 1

        class NoArray(ValueError):
            pass

        def elements(data, bits):
            """The bytes of each element. Anything but one array with its elements raises NoArray."""
            held, depth, quoted, at, found, closed = bytearray(), 0, False, 0, False, False
            for piece in pieces(data, bits):
                held += piece
                while True:
                    if closed:
                        if held.strip(blank):
                            raise NoArray("text after the array")
                        held.clear()
                        at = 0
                        break
                    mark = (inside if quoted else deeper if depth > 1 else outside).search(held, at)
                    if mark is None:
                        at = len(held)
                        break
                    at, sign = mark.end(), mark.group()
                    if quoted:
                        if sign == b'"':
                            quoted = False
                        elif at >= len(held):
                            # what is escaped comes with the next piece
                            at -= 1
                            break
                        else:
                            at += 1
                    elif sign == b'"':
                        quoted = True
                    elif sign in b"[{":
                        depth += 1
                        if depth == 1:
                            if sign != b"[" or held[: at - 1].strip(blank):
                                raise NoArray("no array")
                            del held[:at]
                            at = 0
                    elif sign in b"]}":
                        depth -= 1
                        if depth < 0:
                            raise NoArray("no array")
                        if depth == 0:
                            element = bytes(held[: at - 1]).strip(blank)
                            if sign != b"]" or (found and not element):
                                raise NoArray("no whole array")
                            if element:
                                yield element
                            del held[:at]
                            at, closed = 0, True
                    elif depth == 1:
                        element = bytes(held[: at - 1]).strip(blank)
                        if not element:
                            raise NoArray("an element is missing")
                        found = True
                        yield element
                        del held[:at]
                        at = 0
                    elif depth == 0:
                        raise NoArray("no array")
                if len(held) > (max_record if depth else max(piece_bytes, 1 << 16)):
                    raise NoArray("an element is too large" if depth else "no array")
            if not closed:
                raise NoArray("no whole array")

        def as_text(element):
            text = element.decode("utf-8")
            if text.startswith('"'):
                try:
                    return json.loads(text)
                except ValueError:
                    return text
            return None if text == "null" else text

        def short_text(data, bits):
            """The whole text of a payload that is no array, if one piece holds it."""
            whole = b""
            for piece in pieces(data, bits):
                whole += piece
                if len(whole) > piece_bytes:
                    return None
            return whole.decode("utf-8")

        def decided(data, declared):
            """The setting under which a payload is a whole array, or else the one record that stands for it."""
            failure = "no text"
            for bits in settings(data, declared):
                try:
                    for element in elements(data, bits):
                        as_text(element)
                    return bits, None, True
                except NoArray as reason:
                    try:
                        text = short_text(data, bits)
                    except (EOFError, zlib.error, UnicodeDecodeError) as broken:
                        text, reason = None, broken
                    return bits, text if text is not None else f"undecodable payload: {type(reason).__name__}: {reason}", False
                except (EOFError, zlib.error, UnicodeDecodeError) as broken:
                    failure = f"{type(broken).__name__}: {broken}"
            return None, f"undecodable payload: {failure}", False

        def records(data, declared):
            if data is None:
                yield "undecodable payload: no text"
                return
            bits, stand_in, whole = decided(data, declared)
            if whole:
                yield from map(as_text, elements(data, bits))
            else:
                yield stand_in

        for batch in batches:
            others = pa.Table.from_batches([batch.select(kept_names)])
            held, rows, size = [], [], 0

            def flush(held=held, rows=rows, others=others):
                columns = [column.combine_chunks() for column in others.take(pa.array(rows, pa.int64())).columns]
                columns = [c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in columns]
                return pa.RecordBatch.from_arrays([*columns, pa.array(held, pa.string())], [*kept_names, "record"])

            for row in range(batch.num_rows):
                data, declared = (batch.column(batch.schema.get_field_index(name))[row].as_py() for name in (payload, encoding))
                for record in records(data, declared):
                    held.append(record)
                    rows.append(row)
                    size += len(record or "") + 16
                    if size >= batch_bytes:
                        yield flush()
                        held.clear()
                        rows.clear()
                        size = 0
            if held:
                yield flush()

    return cut_batches
