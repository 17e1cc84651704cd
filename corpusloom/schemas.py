"""Explicit schemas, and the enumerations of statuses."""

from __future__ import annotations

SEGMENT = "reference string, book_code string, book_name string, chapter int, verse string, text string, label string, version string, version_id int, url string, source_file string, language_status string, content_hash string"
DUPLICATE = "reference string, version string, kept_file string, dropped_file string"
CHAPTER_TASK = "version string, book string, book_code string, chapter int, url string, discovered_at string, status string"
STATE = "version string, chapter_key string, status string, url string, attempts int, error string, verses int, language_status string, content_hash string, updated_at string"
CAPTURE = """version string, version_id int, version_code string, book_code string, book_name string, chapter int, url string, retrieved_at string, content_hash string,
page struct<title:string,url:string,canonical:string,og_url:string,lang:string,h1:string,version_links:array<string>>, chapter_label string, heading string, selector_fallback boolean,
navigation_attempts int, anomalies array<string>, language_verification struct<status:string,failing:array<string>>, verse_count int,
verses array<struct<verse:string,reference:string,label:string,text:string,span_count:int,parts:array<struct<text:string,note_before:boolean>>>>"""
CURATED = "id bigint, ref string, a_text string, b_text string, source_id string, split string, status string, notes string, created_at timestamp, updated_at timestamp"
SOURCE = "source_id string, title string, provider string, license string, rights_status string, canonical_url string, notes string"
SFT = "messages array<struct<role:string,content:string>>"

ALIGNMENT_STATUSES = ["aligned", "missing_a", "missing_b", "duplicate_a", "duplicate_b", "language_uncertain", "extraction_error"]
SPLITS = ["train", "validation", "test"]
REVIEW_STATUSES = ["unreviewed", "approved", "corrected", "rejected"]
STATES = ["discovered", "queued", "fetching", "extracted", "verified", "failed"]
COMPLETE_STATES = ["extracted", "verified"]
PUBLIC_RIGHTS = ["OPEN_LICENSE", "PUBLIC_DOMAIN"]
VERIFIED, UNCERTAIN = "verified", "LANGUAGE_UNCERTAIN"
