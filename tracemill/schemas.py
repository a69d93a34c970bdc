"""Explicit schemas; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, IntegerType, LongType, StringType, StructField, StructType,
)

TEXT, LONG, INT, FLAG = StringType(), LongType(), IntegerType(), BooleanType()


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


EVENT_LINE = struct(type=TEXT, repo=struct(name=TEXT), created_at=TEXT, payload=TEXT)

# Every leaf is read as text: flags may be booleans or strings, numbers may be junk.
EVENT_PAYLOAD = struct(
    action=TEXT,
    pull_request=struct(
        number=TEXT, merged=TEXT, html_url=TEXT, title=TEXT, body=TEXT, merge_commit_sha=TEXT, additions=TEXT,
        deletions=TEXT, changed_files=TEXT,
    ),
    issue=struct(number=TEXT),
)

CANDIDATE = struct(
    repo_name=TEXT, pr_number=LONG, pr_url=TEXT, pr_title=TEXT, pr_body=TEXT, merge_commit_sha=TEXT, additions=LONG,
    deletions=LONG, changed_files=LONG, issue_comment_events=LONG, review_events=LONG, review_comment_events=LONG,
    first_seen_at=TEXT, last_seen_at=TEXT,
)

USER = struct(login=TEXT, type=TEXT, html_url=TEXT)
COMMENT = struct(id=LONG, user=USER, body=TEXT, created_at=TEXT, updated_at=TEXT, html_url=TEXT)
FILE = struct(
    filename=TEXT, status=TEXT, additions=LONG, deletions=LONG, changes=LONG, patch=TEXT, raw_url=TEXT, blob_url=TEXT,
    previous_filename=TEXT,
)
REVIEW = struct(id=LONG, user=USER, state=TEXT, body=TEXT, submitted_at=TEXT, commit_id=TEXT, html_url=TEXT)
REVIEW_COMMENT = struct(
    id=LONG, user=USER, path=TEXT, diff_hunk=TEXT, body=TEXT, created_at=TEXT, updated_at=TEXT, commit_id=TEXT,
    original_commit_id=TEXT, line=LONG, original_line=LONG, html_url=TEXT,
)
API_ERROR = struct(stage=TEXT, error_type=TEXT, message=TEXT, status_code=LONG)

FAILURE = struct(
    repo_name=TEXT, pr_number=LONG, candidate=CANDIDATE, error_type=TEXT, error_message=TEXT, retrieved_at=TEXT,
)

ENRICHED = struct(
    repo_name=TEXT,
    pr_number=LONG,
    candidate=CANDIDATE,
    pr=struct(
        html_url=TEXT, title=TEXT, body=TEXT, user=USER, author_association=TEXT, merged=FLAG, created_at=TEXT,
        updated_at=TEXT, closed_at=TEXT, merged_at=TEXT, base=struct(sha=TEXT), head=struct(sha=TEXT),
        merge_commit_sha=TEXT, changed_files=LONG, additions=LONG, deletions=LONG, commits=LONG,
    ),
    files=ArrayType(FILE),
    reviews=ArrayType(REVIEW),
    review_comments=ArrayType(REVIEW_COMMENT),
    pr_comments=ArrayType(COMMENT),
    full_diff=TEXT,
    linked_issue_number=LONG,
    linked_issue=struct(html_url=TEXT, title=TEXT, body=TEXT, user=USER, created_at=TEXT, updated_at=TEXT),
    linked_issue_comments=ArrayType(COMMENT),
    api_errors=ArrayType(API_ERROR),
    retrieved_at=TEXT,
)
