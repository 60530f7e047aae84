"""Coverage payload decoding (C1: S2, S3, F20–F23) as a Spark job over a payload table.

A payload is an XML document with two whitespace tables: positions (``lat lon epoch`` per line)
and values (up to 8 measures per line, ``NaN`` for missing). The reference keeps only the last
line of each; here line *i* is paired with line *i* and every observation becomes a row, with
``latest_only=True`` giving the reference's single newest row.

Each document is first checked with ``from_xml`` in PERMISSIVE mode (its ``_corrupt_record`` is
set for anything not well-formed: truncated, mis-nested, plain text); only documents that pass
are read. Elements are found by namespace, by the scopes of its declarations. Commented-out
markup is not read; character references and CDATA inside a section are decoded. All of it works on a
batch and on a stream of payloads alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions import ntz_literal, num_or_null, strip_ws
from stationlake.schemas import MEASURES, PAYLOAD_NAN_TOKEN, PAYLOAD_POSITIONS, PAYLOAD_VALUES

DECODED_COLUMNS = ["station_id", "latitude", "longitude", "timestamp", *MEASURES]


def _epoch() -> F.Column:
    return ntz_literal("1970-01-01 00:00:00")


TOKEN_SPLIT = r"\s+"
# Epochs that are a timestamp (years 1 to 9999).
MIN_EPOCH, MAX_EPOCH = -62_135_596_800, 253_402_300_799


def _first_element(text: str, name: str) -> F.Column:
    """The first element of that local name, whatever its prefix, from its start tag to the ``</`` after its text
    (attributes allowed, no child elements); empty if there is none. The pattern is constant."""
    return F.regexp_extract(text, rf"<(?:[A-Za-z_][\w.-]*:)?{name}(?:\s(?:[^>]*[^>/])?)?>[^<]*+(?:<!\[CDATA\[[\s\S]*?\]\]>[^<]*+)*</", 0)


def _bound_once(text: str, element: str, uri: str) -> F.Column:
    """Whether the prefix of a found element is declared exactly once in the document, for this URI: then every
    element with that prefix is in the namespace, and no scopes need be looked at."""
    declared = f"concat('xmlns:', split_part(split_part({element}, ':', 1), '<', 2), '=')"
    before, after = (F.expr(f"substring_index({text}, {declared}, {n})") for n in (1, -1))
    # what stands before the first and after the last one is all the rest (both are the whole text if there is none)
    once = F.octet_length(before) + F.expr(f"octet_length({declared})") + F.octet_length(after) == F.octet_length(text)
    prefixed = F.expr(f"instr(split_part({element}, '>', 1), ':')") > 0
    return prefixed & once & (after.startswith(f'"{uri}"') | after.startswith(f"'{uri}'"))


_DECLARATION = r"""(?<![\w:.-])xmlns(?::([A-Za-z_][\w.-]*))?\s*=\s*("[^"]*"|'[^']*')"""


_TAG = r"""^((?:[^>"']|"[^"]*"|'[^']*')*)>"""


def _bind(value: F.Column, use) -> F.Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _pieces(text: F.Column) -> F.Column:
    """A document cut before its tags, each piece a tag and the text after it; plain CDATA sections become text."""
    return F.split(F.regexp_replace(text, r"<!\[CDATA\[([^<&]*?)\]\]>", "$1"), "<")


def _tags(pieces: F.Column) -> F.Column:
    """The tags of a document: kind (start, end, other), prefix, local name, namespace declarations, the text
    after it, and whether an end tag follows that."""
    def one(piece: F.Column, i: F.Column) -> F.Column:
        return _bind(F.regexp_extract(piece, _TAG, 1), lambda tag: _bind(
            F.regexp_extract(tag, r"^[^\s/>]+", 0), lambda name: read(piece, i, tag, name)))

    def read(piece: F.Column, i: F.Column, tag: F.Column, name: F.Column) -> F.Column:
        kind = (F.when((i == 0) | tag.rlike("^[?!]") | tag.endswith("/"), F.lit("other"))
                .when(tag.startswith("/"), F.lit("end")).otherwise(F.lit("start")))
        declared = F.zip_with(
            F.regexp_extract_all(tag, F.lit(_DECLARATION), F.lit(1)), F.regexp_extract_all(tag, F.lit(_DECLARATION), F.lit(2)),
            lambda p, u: F.struct(p.alias("p"), F.substr(u, F.lit(2), F.length(u) - 2).alias("u")))
        return F.struct(
            kind.alias("kind"), F.when(name.contains(":"), F.split_part(name, F.lit(":"), F.lit(1))).otherwise("").alias("prefix"),
            F.split_part(name, F.lit(":"), F.lit(-1)).alias("local"), declared.alias("ns"),
            F.get(pieces, i + 1).startswith("/").alias("leaf"), F.substr(piece, F.length(tag) + 2).alias("text"))

    return F.transform(pieces, one)


def _scoped_text(tags: F.Column, element: tuple[str, str]) -> F.Column:
    """Text of the first element of a namespace, by the scopes of the declarations: a fold over the document's tags
    that keeps the declarations of the open elements, innermost first."""
    uri, name = element

    def step(a: F.Column, t: F.Column) -> F.Column:
        inner = F.when(F.size(t["ns"]) == 0, a["b"]).otherwise(F.concat(
            F.transform(t["ns"], lambda x: F.struct((a["n"] + 1).alias("d"), x["p"].alias("p"), x["u"].alias("u"))), a["b"]))
        bound = F.get(F.filter(inner, lambda x: x["p"] == t["prefix"]), F.lit(0))["u"]
        # (the scopes are searched for elements of that name only)
        mine = F.when((t["local"] == name) & t["leaf"], F.when(bound == uri, t["text"]))
        opened = F.struct(inner.alias("b"), (a["n"] + 1).alias("n"), mine.alias("text"))
        closed = F.struct(F.filter(a["b"], lambda x: x["d"] < a["n"]).alias("b"), (a["n"] - 1).alias("n"), a["text"].alias("text"))
        return F.when(a["text"].isNotNull() | (t["kind"] == "other"), a).when(t["kind"] == "end", closed).otherwise(opened)

    start = F.struct(F.array().cast("array<struct<d:int,p:string,u:string>>").alias("b"), F.lit(0).alias("n"),
                     F.lit(None).cast("string").alias("text"))
    return F.aggregate(tags, start, step, lambda a: a["text"])


def _sections(payloads: DataFrame, station: str, xml: str, latest_only: bool) -> DataFrame:
    """Per document: well-formedness, then the positions and values text, then a reject reason.

    The XML check is one ``from_xml`` parse in its own projection (Catalyst will not inline it
    into the next ones, which use it repeatedly). The two sections are then cut out of the checked
    text, less its comments, by one constant pattern each, which avoids a DOM parse per section. An
    element is known by its namespace: a prefix declared once settles it; any other document
    (default namespaces, several prefixes for a URI, a prefix declared again) is read tag by tag.
    """
    doc = F.col(xml)
    corrupt = F.from_xml(doc, "_corrupt_record string", {"mode": "PERMISSIVE"})["_corrupt_record"]
    checked = payloads.select(F.col(station).cast("string").alias("payload_station"), doc.alias("xml"),
                              (doc.isNotNull() & corrupt.isNull()).alias("well_formed"))
    plain = checked.select("payload_station", "xml", "well_formed", F.when(F.col("well_formed"), F.when(
        F.contains("xml", F.lit("<!--")), F.regexp_replace("xml", r"<!--[\s\S]*?-->", "")).otherwise(F.col("xml"))).alias("plain"))
    elements = {"pos": PAYLOAD_POSITIONS, "val": PAYLOAD_VALUES}
    found = plain.select("*", *[_first_element("plain", name).alias(c) for c, (_, name) in elements.items()])
    odd = F.rlike("plain", F.lit(r"xmlns(?::[\w.-]+)?\s"))  # a declaration that the prefix search would miss
    judged = found.select("*", *[(~odd & _bound_once("plain", c, uri)).alias(f"{c}_sure") for c, (uri, _) in elements.items()])
    sure = F.coalesce(F.col("pos_sure") & F.col("val_sure"), F.lit(False))
    # in a projection of their own: both elements read them
    tagged = judged.select("*", F.when(F.col("well_formed") & ~sure, _tags(_pieces(F.col("plain")))).alias("tags"))

    def text(c: str) -> F.Column:
        cut = F.expr(f"substr({c}, locate('>', {c}) + 1, length({c}) - locate('>', {c}) - 2)")
        return F.when(sure, cut).when(F.col("well_formed"), F.coalesce(_scoped_text(F.col("tags"), elements[c]), F.lit("")))

    texts = tagged.select("payload_station", "xml", "well_formed", *[text(c).alias(f"{c}_raw") for c in elements])
    # only what needs it goes through an XML parser again
    decoded = lambda c: strip_ws(F.when(c.rlike("[&]|<!"), F.xpath_string(
        F.concat(F.lit("<t>"), c, F.lit("</t>")), F.lit("/t"))).otherwise(c))
    ok = F.col("well_formed")
    sections = texts.select("payload_station", "xml", "well_formed", *[
        F.when(ok, decoded(F.col(f"{c}_raw"))).alias(f"{c}_text") for c in elements])
    lines = lambda c: F.size(F.split(c, "\n"))
    reason = (F.when(~ok, F.lit("malformed_xml"))
              .when(F.col("pos_text") == "", F.lit("missing_positions"))
              .when(F.col("val_text") == "", F.lit("missing_values")))
    if not latest_only:  # lines are paired by number, so the two tables must have as many
        reason = reason.when(lines("pos_text") != lines("val_text"), F.lit("line_count_mismatch"))
    return sections.select("payload_station", "xml", reason.alias("reject_reason"), "pos_text", "val_text")


def _parse_lines(rows: DataFrame) -> DataFrame:
    """(payload_station, xml, doc_reason, p, v) line pairs → typed rows with a ``reject_reason``.

    Tokens are split in their own projection first; Catalyst keeps it separate (it does not
    collapse projections that would repeat a non-trivial expression), so each line is split once.
    """
    toks = rows.select(
        "xml", "doc_reason", strip_ws(F.col("payload_station")).try_cast("bigint").alias("station_id"),
        F.split(strip_ws("p"), TOKEN_SPLIT).alias("pt"), F.split(strip_ws("v"), TOKEN_SPLIT).alias("vt"),
        (F.coalesce(strip_ws("v"), F.lit("")) == "").alias("empty_values"))
    pt, vt = F.col("pt"), F.col("vt")
    epoch = F.get(pt, 2).try_cast("bigint")
    parsed = toks.select(
        "xml", "doc_reason", "station_id",
        num_or_null(F.get(pt, 0)).alias("latitude"),
        num_or_null(F.get(pt, 1)).alias("longitude"),
        F.timestamp_add("SECOND", F.when(epoch.between(MIN_EPOCH, MAX_EPOCH), epoch), _epoch()).alias("timestamp"),
        *[num_or_null(F.get(vt, i)).alias(m) for i, m in enumerate(MEASURES)],
        "empty_values")
    reason = (F.when(F.col("doc_reason").isNotNull(), F.col("doc_reason"))
              .when(F.col("station_id").isNull(), F.lit("bad_station_id"))
              .when(F.col("timestamp").isNull() | F.col("latitude").isNull() | F.col("longitude").isNull(),
                    F.lit("bad_position"))
              .when(F.col("empty_values"), F.lit("empty_values")))
    return parsed.withColumn("reject_reason", reason).drop("empty_values", "doc_reason")


def _lines(payloads: DataFrame, station: str, xml: str, latest_only: bool) -> DataFrame:
    """Every payload line as a row; a document that fails as a whole gives one row with its reason.

    Nothing is filtered before the explode: a filter there would be pushed into the XML checks
    and repeat them. Bad documents explode to a single placeholder pair instead.
    """
    sec = _sections(payloads, station, xml, latest_only)
    pos_lines = F.split("pos_text", "\n")
    val_lines = F.split("val_text", "\n")
    if latest_only:
        pairs = F.array(F.struct(F.element_at(pos_lines, -1).alias("p"), F.element_at(val_lines, -1).alias("v")))
    else:
        pairs = F.arrays_zip(pos_lines.alias("p"), val_lines.alias("v"))
    none = F.lit(None).cast("string")
    placeholder = F.array(F.struct(none.alias("p"), none.alias("v")))
    rows = sec.select("payload_station", "xml", F.col("reject_reason").alias("doc_reason"),
                      F.inline(F.when(F.col("reject_reason").isNull(), pairs).otherwise(placeholder)))
    return _parse_lines(rows)


def decode_payloads(payloads: DataFrame, station: str = "station_id", xml: str = "xml",
                    latest_only: bool = False) -> DataFrame:
    """Observation rows of every payload (one per line, or the newest line with ``latest_only``)."""
    rows = _lines(payloads, station, xml, latest_only)
    # a zero-or-one-row generator: a filter would be pushed down, and split and cast every line again
    row = F.array(F.struct(*DECODED_COLUMNS))
    return rows.select(F.inline(F.when(F.col("reject_reason").isNull(), row)))


def decoded_and_rejected(payloads: DataFrame, station: str = "station_id", xml: str = "xml",
                         latest_only: bool = False) -> DataFrame:
    """Every line with its ``reject_reason`` (null: accepted), for callers that write both outcomes; ``xml`` is kept of
    rejected lines only."""
    rows = _lines(payloads, station, xml, latest_only)
    bad = F.col("reject_reason").isNotNull()
    return rows.select(*DECODED_COLUMNS, "reject_reason", F.col("station_id").cast("string").alias("station"),
                       F.when(bad, F.col("xml")).alias("xml"))


def payload_rejects(payloads: DataFrame, station: str = "station_id", xml: str = "xml",
                    latest_only: bool = False) -> DataFrame:
    """Payloads (or single lines) that yield no record, with the reason."""
    return (_lines(payloads, station, xml, latest_only).where(F.col("reject_reason").isNotNull())
            .select(F.col("station_id").cast("string").alias("station"), "xml", "reject_reason"))


def _num_text(c: F.Column) -> F.Column:
    return F.coalesce(c.cast("string"), F.lit(PAYLOAD_NAN_TOKEN))


def value_tokens(measures: list[F.Column]) -> list[F.Column]:
    """Payload text of each measure, ``NaN`` for null."""
    return [_num_text(m) for m in measures]


def encode_payload(lines: list[tuple[F.Column, F.Column, F.Column, list[F.Column]]]) -> F.Column:
    """Build a payload document from (lat, lon, epoch, [value tokens]) column tuples, one per line.
    A null token is left out of its line (a short line)."""
    pos = F.concat_ws("\n", *[F.concat_ws(" ", _num_text(la), _num_text(lo), e.cast("string"))
                              for la, lo, e, _ in lines])
    val = F.concat_ws("\n", *[F.concat_ws(" ", *toks) for _, _, _, toks in lines])
    return F.concat(
        F.lit('<wfs:FeatureCollection xmlns:wfs="http://www.opengis.net/wfs/2.0" '
              'xmlns:gml="http://www.opengis.net/gml/3.2" xmlns:gmlcov="http://www.opengis.net/gmlcov/1.0">'
              "<wfs:member><gmlcov:MultiPointCoverage><gml:domainSet><gmlcov:SimpleMultiPoint>"
              "<gmlcov:positions>\n"), pos,
        F.lit("\n</gmlcov:positions></gmlcov:SimpleMultiPoint></gml:domainSet><gml:rangeSet><gml:DataBlock>"
              "<gml:doubleOrNilReasonTupleList>\n"), val,
        F.lit("\n</gml:doubleOrNilReasonTupleList></gml:DataBlock></gml:rangeSet>"
              "</gmlcov:MultiPointCoverage></wfs:member></wfs:FeatureCollection>"))


def epoch_seconds(ts: F.Column) -> F.Column:
    """TIMESTAMP_NTZ → whole epoch seconds, zone-free."""
    return F.timestamp_diff("SECOND", _epoch(), ts)
