"""File path classification as Column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions, names and path fragments.
DOC_EXTENSIONS = [".md", ".rst", ".txt", ".adoc"]
DOC_FRAGMENTS = ["docs/", "doc/", "documentation/", "changelog", "changeset"]
LOCKFILE_NAMES = [
    "package-lock.json", "yarn.lock", "pnpm-lock.yaml", "poetry.lock", "Pipfile.lock",
    "Cargo.lock", "go.sum", "composer.lock", "Gemfile.lock",
]
GENERATED_FRAGMENTS = [
    "vendor/", "dist/", "build/", "generated/", "gen/", "__generated__/", "autogen/",
    "migrations/", "node_modules/", "third_party/", ".pb.", ".generated.",
]
LANGUAGES = {
    ".py": "python",
    ".js": "javascript", ".jsx": "javascript",
    ".ts": "typescript", ".tsx": "typescript",
    ".go": "go",
    ".java": "java",
    ".rs": "rust",
    ".cpp": "c++", ".cc": "c++", ".hpp": "c++",
    ".c": "c/c++", ".h": "c/c++",
    ".cs": "c#",
    ".rb": "ruby",
    ".php": "php",
    ".swift": "swift",
    ".kt": "kotlin",
    ".scala": "scala",
}
SOURCE_EXTENSIONS = list(LANGUAGES)
LANGUAGE_NAMES = sorted(set(LANGUAGES.values()))


def _contains_any(text: Column, fragments: list[str]) -> Column:
    return reduce(or_, [text.contains(f) for f in fragments])


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _last_extension(name: Column) -> Column:
    return F.when(name.contains("."), F.concat(F.lit("."), F.substring_index(name, ".", -1))).when(
        name.isNotNull(), ""
    )


def file_ext(path: Column) -> Column:
    """Lower-cased extension of the last path part; leading dots do not start one."""
    return F.lower(_last_extension(F.ltrim(base_name(path), F.lit("."))))


def path_suffix(path: Column) -> Column:
    """Lower-cased final suffix, ``[none]`` when there is none or it is a lone dot."""
    ext = file_ext(F.rtrim(F.coalesce(path, F.lit("")), F.lit("/")))
    return F.when(F.length(ext) > 1, ext).otherwise(F.lit("[none]"))


def tail_extension(path: Column) -> Column:
    """Text after the last dot of the whole path with its dot, case kept, or empty."""
    return _last_extension(F.coalesce(path, F.lit("")))


def is_doc(ext: Column, low: Column) -> Column:
    """Same as ``is_doc_file`` from a ready extension and lower-cased path."""
    return ext.isin(DOC_EXTENSIONS) | _contains_any(low, DOC_FRAGMENTS)


def is_doc_file(path: Column) -> Column:
    return is_doc(file_ext(path), F.lower(path))


def is_lockfile(path: Column) -> Column:
    return base_name(path).isin(LOCKFILE_NAMES)


def is_generated(low: Column) -> Column:
    return _contains_any(low, GENERATED_FRAGMENTS)


def is_generated_or_vendor(path: Column) -> Column:
    return is_generated(F.lower(path))


def is_source_file(path: Column) -> Column:
    return file_ext(path).isin(SOURCE_EXTENSIONS)


def language_of_ext(ext: Column) -> Column:
    """Lookup in a constant map, so the extension is computed once per row."""
    pairs = [F.lit(v) for pair in LANGUAGES.items() for v in pair]
    return F.create_map(*pairs)[ext]


def source_language(path: Column) -> Column:
    """Language name, null when the path is no source file."""
    return language_of_ext(file_ext(path))
