"""Whole texts through the queries that have no twin in SQL, held against plain Python."""

import hashlib
import re

from storyloom.plans import catalogue


def documents(spark, tmp_path, texts):
    rows = [(i, t, "en", "web, app") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


def struck(text):
    """Without dashes' struck text, character by character."""
    out, i = [], 0
    while i < len(text):
        end = None
        if text[i] == "-" and (i == 0 or text[i - 1] in " \n("):
            line = text[i + 1 :].split("\n")[0]
            if line and line[0] not in " -":
                end = next((k for k in range(1, len(line)) if line[k] == "-" and line[k - 1] not in " -" and (i + k + 2 == len(text) or text[i + k + 2] in " \n.,;:)")), None)
        if end is None:
            out.append(text[i])
            i += 1
        else:
            i += end + 2
    return "".join(out)


def cleaned(text):
    text = text.strip(" ")
    text = re.sub(r"(?is)<(s|strike|del)\b[^>]*>.*?</\1>", "", text)
    text = re.sub(r"(?is)<(\w+)[^>]*line-through[^>]*>.*?</\1>", "", text)
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"\{color(:[^}]+)?\}", "", struck(text)))


TEXTS = [
    "plain", "", None, "\nblank first line\nand more", "first\r\nsecond -gone-\r\nthird\r\n\r\n\r\n\r\nlast", "a\rb\r## C\rd", "title: with colon\nbody " + "word " * 3000 + "the end",
    "t\nh2. Part\none\n## Part\ntwo\n## Other\nthree\n### deep\nfour", "t\n- **Type**: Fake\n- **Components**: none\n", "# t\n* a\n* b\n*bold* and {{code}} {color:red}red{color}",
    "x\u2028## no heading\u2028* no item\u2028h1. none", "t\nold -struck text- new, state-of-the-art - not this -\n-a list\n- item -b-.", "<s>gone</s> stays <DEL class=x>also\ngone</DEL> end", "## Description\nown one", "  \n\n  spaced  \n\n\n\n\nend  ",
]


def round_trip(key, text):
    """What a line-by-line parser finds in the file that is written for a text."""
    text = text or ""
    summary, body = re.split(r"\r\n?|\n", text)[0], cleaned(re.sub(r"\r\n?", "\n", text))
    lines = [f"# {key}: {summary}", "", "- **Components**: web, app", "- **Type**: en"]
    if text.strip(" "):
        lines += ["", "## Description", ""]
        for x in body.split("\n"):
            x = re.sub(r"^#\s", "1. ", re.sub(r"^\*\s", "- ", x))
            x = re.sub(r"\{\{([^}]+)\}\}", r"`\1`", re.sub(r"\*([^*\n]+)\*", r"**\1**", x))
            lines.append(re.sub(r"^h([1-6])\.\s*", lambda m: "#" * int(m[1]) + " ", x))
    sections, here = [], None
    for x in lines:
        if x.startswith("## "):
            here = [x[3:].strip(), []]
            sections.append(here)
        elif here:
            here[1].append(x)
    last = {name: k for k, (name, _) in enumerate(sections)}
    whole = "\n## ".join(f"{name}\n" + "\n".join(x).strip() for k, (name, x) in enumerate(sections) if last[name] == k)
    return summary.strip(), "web, app", "en", len(last), len(whole), digest(whole)


def test_round_trip_of_whole_texts(spark, tmp_path):
    got = catalogue.QUERIES["md_roundtrip_whole"](spark, documents(spark, tmp_path, TEXTS)).collect()
    assert {int(r["story_id"]): tuple(r)[1:] for r in got} == {k: round_trip(k, t) for k, t in enumerate(TEXTS)} and len(got) == len(TEXTS)


def test_markup_of_all_documents(spark, tmp_path):
    got = catalogue.QUERIES["markup_clean"](spark, documents(spark, tmp_path, TEXTS)).collect()
    want = {k: (None, None) if t is None else (len(cleaned(t)), digest(cleaned(t))) for k, t in enumerate(TEXTS)}
    assert {r["doc_id"]: (r["n"], r["digest"]) for r in got} == want and len(got) == len(TEXTS)
    assert want[11][0] < len(TEXTS[11])  # struck text goes
