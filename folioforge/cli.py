"""Commands over a book's folder: `python -m folioforge.cli run|validate|preview FOLDER`.

run translates, normalizes, chunks, reports and previews; it ends with 1 if a chapter's translation failed, and names the audit. validate
writes the report; preview writes the Markdown preview, from the report on file unless it is missing or is to be refreshed.
Each prints what it has made.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .operators.chunks import counts_by_type
from .operators.translate import Model, ModelSettings, TranslationError, http_model
from .plans import pipeline as book
from .sources import readers


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="folioforge", description=__doc__.partition("\n")[0])
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in (("run", "all stages from parsed chapters on"), ("validate", "the report of the files as they are"), ("preview", "the Markdown preview")):
        own = commands.add_parser(name, help=text)
        own.add_argument("folder", help="the book's folder, any path that Spark can open")
        if name == "run":
            own.add_argument("--chapters", type=int, nargs="+", help="numbers to translate, in this order; all if not given")
            own.add_argument("--force", action="store_true", help="translate also what is in the cache")
            own.add_argument("--aliases", required=True, help="alias file")
            own.add_argument("--settings", default="MODEL", help="prefix of the environment variables of the model")
            own.add_argument("--at-once", type=int, default=1, help="requests under way in a task")
            own.add_argument("--per-second", type=float, help="requests that a task starts in a second")
            own.add_argument("--wave", type=int, help="chapters after which the cache is written")
        if name == "preview":
            own.add_argument("--refresh", action="store_true", help="make the report anew")
    return parser


def _say(**made: object) -> None:
    for name, value in made.items():
        print(f"{name.replace('_', ' ')}: {value}")


def _report(row: DataFrame) -> dict[str, object]:
    r = row.select("parsing.detected_chapters", "translation.translated_chapters", "chunking.total_chunks", "warnings").first()
    return {"parsed_chapters": r.detected_chapters, "translated_chapters": r.translated_chapters, "chunks": r.total_chunks, "warnings": len(r.warnings)}


def _run(spark: SparkSession, ws: book.Workspace, args: argparse.Namespace, make_model: Callable[[], Model] | None) -> int:
    if make_model is None:
        settings = ModelSettings.from_env(args.settings)
        retries, make_model = settings.max_retries, lambda: http_model(settings)
    else:
        retries = 3
    try:
        done = book.translate_file(spark, ws, make_model, args.chapters, args.force, retries, args.at_once, args.per_second, args.wave)
    except TranslationError as e:
        print(f"{e}\nsee {ws.path('translation_audit.jsonl')}", file=sys.stderr)
        return 1
    status = dict(done.groupBy("status").count().collect())
    _say(translated=status.get("translated", 0), from_the_cache=status.get("cached", 0), translation=ws.path("chapters_english.json"), audit=ws.path("translation_audit.jsonl"))
    normalized = book.normalize_file(spark, ws, readers.read_aliases(args.aliases))
    _say(normalized_chapters=normalized.count(), normalized=ws.path("chapters_english_normalized.json"), entity_audit=ws.path("entity_normalization_audit.json"))
    kinds = {r.chunk_type: r.n for r in sorted(counts_by_type(book.chunk_file(spark, ws)).collect())}
    _say(chunks=sum(kinds.values()), chunks_by_type=kinds, files=ws.path("processed"))
    report = book.report_file(spark, ws)
    _say(warnings=_report(report)["warnings"], report=ws.path("processed/validation_report.json"))
    _say(preview_characters=len(book.preview_file(spark, ws)), preview=ws.path("processed/final_chunks_preview.md"))
    return 0


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None, make_model: Callable[[], Model] | None = None) -> int:
    """The exit code. spark and make_model take the place of the session and of the model that the settings name."""
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("folioforge").getOrCreate()
    ws = book.Workspace(args.folder)
    if args.command == "run":
        return _run(spark, ws, args, make_model)
    if args.command == "validate":
        _say(report=ws.path("processed/validation_report.json"), **_report(book.report_file(spark, ws)))
        return 0
    _say(preview=ws.path("processed/final_chunks_preview.md"), preview_characters=len(book.preview_file(spark, ws, refresh=args.refresh)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
