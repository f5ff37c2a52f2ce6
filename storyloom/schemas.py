"""Declared schemas, in DDL: stories, usage, transcripts and the six extracted indexes."""

from __future__ import annotations

SECTION = "struct<content:string,word_count:int,char_count:int,line_count:int>"
STORY = f"story_id string, sprint string, sprint_no int, summary string, metadata map<string,string>, sections map<string,{SECTION}>, file_path string, file_size bigint, total_word_count int, estimated_tokens bigint"
USAGE = "ts timestamp_ntz, day date, user string, kind string, model string, max_mode string, input_with_cache bigint, input_without_cache bigint, cache_read bigint, output_tokens bigint, total_tokens bigint, cost double, source_file string, line bigint"
MESSAGE = "role string, message struct<content:array<struct<type:string,text:string,name:string,input:map<string,string>>>>"

#: Array, key and fields of each index, as its schema declares them.
INDEXES = {
    "glossary": ("terms", "term string, expansion string, definition string, category string, related_sf_object string, found_in array<string>, synonyms array<string>"),
    "story_summaries": ("stories", "id string, summary string, action_type string, entities struct<objects:array<string>,fields:array<string>,roles:array<string>,processes:array<string>,integrations:array<string>>, business_domain string, key_criteria array<string>"),
    "business_rules": ("rules", "story_id string, rule_id string, trigger string, action string, action_type string, conditions array<struct<object:string,field:string,operator:string,value:string>>, objects_involved array<string>, fields_involved array<string>"),
    "semantic_similarity": ("equivalence_groups", "canonical string, variants array<struct<phrase:string,relationship:string,confidence:string>>, category string, related_stories array<string>"),
    "cross_story_links": ("links", "from_story string, to_story string, relationship string, confidence string, reason string, shared_concepts array<string>"),
    "intent_mapping": ("intents", "intent_id string, canonical_question string, query_variations array<string>, business_process string, relevant_objects array<string>, relevant_stories array<string>, relevant_components array<string>, answer_type string"),
}


def index_schema(index: str) -> str:
    array, fields = INDEXES[index]
    inner = ",".join(f"{f.strip()}" for f in _fields(fields))
    return f"struct<{array}:array<struct<{inner}>>>"


def _fields(ddl: str) -> list[str]:
    """name:type of each top-level field."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(ddl + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            name, kind = ddl[at:i].strip().split(" ", 1)
            out.append(f"{name}:{kind}")
            at = i + 1
    return out
