"""Schemas of the datasets, declared once. `ord` is the place of a row in its dataset: order is data here."""

from __future__ import annotations

COLLECTION = "id string, slug string, name string, url string, ord long"
ARTICLE_REF = "id string, slug string, title string, url string, collection string, collection_id string, ord long"
SECTION = "struct<heading: string, level: int, content: string>"
RELATED = "struct<title: string, url: string>"
CONTENT = f"struct<raw_html: string, markdown: string, plain_text: string, sections: array<{SECTION}>>"
METADATA = "struct<word_count: bigint, has_images: boolean, has_tables: boolean, has_video: boolean>"
ARTICLE = f"article_id string, url string, title string, description string, collection string, collection_id string, content {CONTENT}, related_articles array<{RELATED}>, metadata {METADATA}"
#: What is read from a page itself.
ARTICLE_BODY = f"title string, description string, content {CONTENT}, related_articles array<{RELATED}>, metadata {METADATA}"
QUESTION = "struct<question: string, type: string, key_info_needed: string>"
QUESTIONS = f"map<string, struct<article_id: string, title: string, collection: string, questions: array<{QUESTION}>>>"
QA_PAIR = "qa_id string, article_id string, question string, question_type string, answer string, collection string, article_title string"
MESSAGES = "array<struct<role: string, content: string>>"
EXAMPLE = f"struct<messages: {MESSAGES}>"
BATCH_REQUEST = f"struct<custom_id: string, method: string, url: string, body: struct<model: string, messages: {MESSAGES}, temperature: double, max_tokens: int>>"
BATCH_RESULT = "custom_id string, error string, content string"
SESSION_COMMAND = "session_id string, seq long, cmd string, arg string"
SESSION_EVENT = "session_id string, seq long, event string, data string"
SESSION_STATE = "key string, turns long"
