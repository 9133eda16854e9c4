"""Schemas of pages, corrections, geometry and the delimited files."""

from __future__ import annotations

RUN = "struct<typeface:string,text:string,placement:string,layout:string,line_span:int,span_id:string>"
LINE = f"struct<id:string,indent:int,runs:array<{RUN}>>"
ZONE = f"struct<id:string,kind:string,label:string,note:string,lines:array<{LINE}>>"
PAGE = (
    "format string, format_version int, id string, "
    "source struct<repository:string,view:string,url:string,master_sha256:string>, scope string, "
    "review struct<origin:string,wikisource_used_for_this_trial:boolean,physical_lineation_checked:boolean,"
    f"status:string,external_check_scope:string>, zones array<{ZONE}>"
)
SELECTOR = "struct<line:string,join:string,span:string,runs:array<int>>"
STRUCTURE = (
    "format string, format_version int, scope string, "
    f"assertions array<struct<id:string,kind:string,claim:string,targets:array<{SELECTOR}>>>, "
    f"reading_sequences array<struct<id:string,label:string,segments:array<{SELECTOR}>>>"
)
CHANGE = "struct<line:string,before:string,after:string,comment:string,second_opinion:boolean>"
PAYLOAD = f"struct<schema:int,page:string,base_commit:string,base_transcription_version:string,changes:array<{CHANGE}>>"
CORRECTIONS = ["event_id", "page", "line", "phase", "step", "before", "after", "outcome", "finder", "categories", "provenance", "note"]
RECT = "struct<x:int,y:int,w:int,h:int>"
BOX = "struct<l:int,t:int,r:int,b:int>"
MANIFEST = (
    "id string, source string, gallica_view string, gallica_item_url string, iiif_image_url string, local_path string, "
    "width int, height int, bytes long, sha256 string, media_type string, resolution string, disposition string, recorded_at string"
)

# Format tags of the files.
COMPACT_FORMAT, COMPACT_VERSION = "nippo-level1-markdown", "1"
PAGE_FORMAT, PAGE_VERSION = "nippo-level1-page", 1

# What a field may hold.
STATUSES = ["visual_draft", "context_reviewed", "scan_confirmed", "human_checked", "trial_reviewed"]
TYPEFACES = ["roman", "italic", "display"]
PLACEMENTS = ["normal", "far-right"]
JOINS = ["space", "none", "word", "newline"]
DECISIONS = ["pending", "reject", "qualify", "accept"]
OUTCOMES = ["accepted", "rejected", "intermediate", "reverted"]
HEADER_KEYS = ["id", "source", "view", "url", "sha256", "scope", "origin", "wikisource", "lineation", "status"]
