"""Explicit schemas of every record kind; nothing is inferred."""

PAGE = "pdf_page_index int, printed_page_number string, raw_text string, extraction_method string"
CLEAN_PAGE = PAGE + ", clean_text string"
TOC_ENTRY = "chapter_number int, kanda_telugu string, chapter_title_telugu string, printed_page_number string"
OPTION = "struct<label:string,text:string>"
SOURCE_QUESTION = (
    f"struct<question_number:int,question_telugu:string,answer_type:string,options_telugu:array<{OPTION}>,"
    "answer_key_telugu:string,answer_telugu:string,parser_warnings:array<string>>"
)
SOURCE_CHAPTER = (
    "chapter_number int, chapter_id string, kanda_telugu string, kanda_english string, kanda_order int, sarga_range string, "
    "chapter_title_telugu string, source_pdf_pages array<int>, printed_page_numbers array<string>, raw_telugu_text string, "
    f"questions array<{SOURCE_QUESTION}>, parser_warnings array<string>, needs_review boolean"
)
MENTION = "struct<alias:string,canonical:string,field:string,category:string,match_type:string>"
TRANSLATED_QUESTION = (
    f"struct<question_number:int,question:string,answer_type:string,options:array<{OPTION}>,correct_answer:string,answer:string,key_entities:array<string>>"
)
TRANSLATED_CHAPTER = (
    "chapter_number int, chapter_id string, kanda string, kanda_order int, sarga_range string, chapter_title string, chapter_summary string, "
    f"questions array<{TRANSLATED_QUESTION}>, canonical_entities array<string>, places array<string>, themes array<string>, "
    "translation_notes array<string>, source_pdf_pages array<int>, printed_page_numbers array<string>"
)
NORMALIZED_QUESTION = TRANSLATED_QUESTION[:-1] + f",entity_mentions:array<{MENTION}>>"
NORMALIZED_CHAPTER = (
    TRANSLATED_CHAPTER.replace(TRANSLATED_QUESTION, NORMALIZED_QUESTION)
    + f", entity_mentions array<{MENTION}>, note_entity_mentions array<{MENTION}>, unmapped_entity_candidates array<string>"
)
AUDIT = (
    "timestamp_utc string, chapter_number int, chapter_id string, cache_path string, force boolean, status string, attempts int, "
    "duration_seconds double, error_type string, error string"
)
METADATA = (
    "struct<document_title:string,source_file:string,language_original:string,language_output:string,kanda:string,kanda_order:int,"
    "chapter_number:int,chapter_title:string,sarga_range:string,question_number:int,chunk_type:string,answer_type:string,"
    f"canonical_entities:array<string>,entity_mentions:array<{MENTION}>,places:array<string>,themes:array<string>,"
    "source_pdf_pages:array<int>,printed_page_numbers:array<string>,translation_model:string,pipeline_version:string>"
)
CHUNK = f"chunk_id string, text string, metadata {METADATA}"
INDEX_COLUMNS = [
    "chapter_number", "chapter_id", "kanda", "kanda_order", "chapter_title", "sarga_range",
    "source_pdf_pages", "printed_page_numbers", "question_count", "chunk_count", "chunk_ids",
]
REPORT = (
    "pipeline_version string, translation_model string, "
    "parsing struct<expected_chapters:int,detected_chapters:long,expected_questions:int,detected_questions:long>, "
    "translation struct<translated_chapters:long>, chunking struct<total_chunks:long,chunk_counts_by_type:map<string,long>>, "
    "entity_normalization struct<chunks_with_canonical_entities:long>, warnings array<string>"
)
