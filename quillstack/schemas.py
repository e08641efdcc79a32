"""Typed tables of a document archive."""

from __future__ import annotations

SOURCE_CATALOG = (
    "name string, title string, authority string, languages array<string>, prefix string, start_date date,"
    " enabled boolean, identifier_rule string"
)
SOURCE = (
    "name string, title string, authority string, languages array<string>, prefix string, start_date date,"
    " gazette_count long, earliest_date date, latest_date date"
)
GAZETTE = (
    "id long, identifier string, relurl string, source_name string, date date, year short, title string, subject string,"
    " gznum string, gztype string, department string, ministry string, office string, partnum string,"
    " notification_num string, refnum string, source_url string, metadata string, text string, text_truncated boolean,"
    " has_alternate boolean, has_pdf boolean, pdf_bytes long, html_sha256 string, metadata_sha256 string,"
    " created_at timestamp, updated_at timestamp"
)
POSTING = "lexeme string, doc long, weight string, positions array<int>"
ASSET = "root int, kind string, relurl string, ext string, size long, mtime timestamp"
BOX = "struct<l:int,t:int,r:int,b:int>"
OCR_WORD = f"doc string, page int, block int, para int, word int, text string, box {BOX}, confidence double, langs array<string>"
SPEECH_WORD = "result int, idx int, word string, start_s double, end_s double"
REG_NODE = "reg string, node int, parent int, tag string, kind string, num string, title string, version int, text string"

#: The longest values that promoted columns take; longer ones become empty.
FIELD_LIMITS = {
    "title": 512, "subject": 2000, "gznum": 128, "gztype": 64, "department": 255, "ministry": 255, "office": 255,
    "partnum": 128, "notification_num": 255, "refnum": 255,
}
