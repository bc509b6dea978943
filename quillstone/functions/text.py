"""Text functions as column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstone.schema import UNCATEGORISED

#: White space as Python's str.strip and \\s see it; Java's \\s is ASCII only.
SPACE = r"[\s\x1c-\x1f\x85   -     　]"
#: The same, letter by letter.
BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
END_MARKER = "<!-- END -->"


def strip(c: Column) -> Column:
    """From both ends; a regular expression would try every run of white space between them."""
    return F.btrim(c, F.lit(BLANKS))


def fingerprint(c: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(c, 256), 1, digits)


def first_line(c: Column) -> Column:
    return F.substring_index(c, "\n", 1)


# --- unit headers

HEADER = rf"(?d)^##{SPACE}*\[([^\]]+)\]{SPACE}*\[P([012])\]{SPACE}*(.*)"


def priority_mark(c: Column) -> Column:
    """0 to 2 for [P0] to [P2] anywhere in the text, the smallest first; 3 without a mark."""
    out = F.lit(3)
    for p in (2, 1, 0):
        out = F.when(c.contains(f"[P{p}]"), p).otherwise(out)
    return out


def unit_header(line: Column) -> Column:
    """Struct of tag, priority and title of a unit's first line."""
    labelled = line.rlike(HEADER)
    bare = F.regexp_replace(line, rf"^##{SPACE}*(\[[^\]]*\]{SPACE}*)*", "")
    return F.struct(
        F.when(labelled, strip(F.regexp_extract(line, HEADER, 1))).otherwise(UNCATEGORISED).alias("tag"),
        F.when(labelled, F.regexp_extract(line, HEADER, 2).try_cast("int")).otherwise(priority_mark(line)).cast("int").alias("priority"),
        strip(F.when(labelled, F.regexp_extract(line, HEADER, 3)).otherwise(bare)).alias("title"),
    )


# --- names, sizes, fences


def safe_filename(c: Column) -> Column:
    c = F.translate(strip(c), "\\", "/")
    c = F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', "_")
    c = F.translate(strip(F.regexp_replace(c, f"{SPACE}+", " ")), " ", "_")
    c = F.regexp_replace(c, r"^[._]+|[._]+\z", "")
    return F.when(c == "", "untitled").otherwise(c)


def batch_name(names: Column) -> Column:
    return F.concat(F.lit("batch_"), fingerprint(F.array_join(F.array_sort(names), "|"), 8), F.lit(".md"))


def payload_kb(name: Column, content: Column) -> Column:
    """KB of the JSON object {"source_file": name, "content": content}, with a blank after : and , (3 bytes)."""
    return (F.octet_length(F.to_json(F.struct(F.coalesce(name, F.lit("")).alias("source_file"), F.coalesce(content, F.lit("")).alias("content")))) + 3) / F.lit(1024.0)


def effective_limit_kb(soft_kb: float, provider: str, limits: dict[str, float], margin: float = 0.85, default_kb: float = 200) -> float:
    return min(soft_kb, limits.get(provider.lower(), default_kb)) * margin


def strip_fences(c: Column) -> Column:
    """What stands between an opening ```, ```markdown, ```md or ```text line and the last fence."""
    s = strip(c)
    opening = strip(first_line(s))
    body = F.substring(s, F.instr(s, "\n") + 1, 1 << 30)
    last = F.length(body) - F.length(F.substring_index(body, "```", -1)) - 3  # characters before the last fence
    fenced = s.startswith("```") & s.contains("\n") & opening.rlike(r"(?i)^```(?:markdown|md|text)?\z") & body.contains("```")
    return F.when(fenced, strip(F.substring(body, F.lit(1), last))).otherwise(s)


def join_continuation(parts: Column) -> Column:
    """Parts of one answer, without separator and without the end mark."""
    return strip(F.replace(F.array_join(parts, ""), F.lit(END_MARKER), F.lit("")))


def sanitize_url(c: Column) -> Column:
    """Values of query parameters whose name tells a secret become ***."""
    return F.regexp_replace(c, r"(?i)([?&][^=&#]*(?:key|token|secret|password|passwd|pwd|auth|signature)[^=&#]*=)[^&#]*", "$1***")


def preview(c: Column, n: int = 80) -> Column:
    return F.translate(F.substring(c, 1, n), "\n", " ")


def pair_key(a: Column, b: Column) -> Column:
    return F.concat_ws("_", F.least(a, b), F.greatest(a, b))


# --- similarity


def clean_for_ngrams(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"[#*\-|>\[\](){}]", ""), f"{SPACE}+", "")


def ngrams(c: Column, n: int) -> Column:
    """Distinct n-grams of a text's code points; none if it is shorter than n. Linear in the text's length."""
    letters = F.split(c, "")
    many = F.greatest(F.size(letters) - (n - 1), F.lit(0))
    runs = F.slice(letters, 1, many)
    for k in range(1, n):
        runs = F.zip_with(runs, F.slice(letters, k + 1, many), lambda a, b: F.concat(a, b))
    return F.array_distinct(runs)


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both.cast("double"), (F.size(a) + F.size(b) - both).cast("double")), F.lit(0.0))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.greatest(F.sqrt(dot(a, a)), F.lit(1e-10))


# --- model answers


def verdict_lines(raw: Column) -> Column:
    """Array of struct(pair, verdict, keep, line) read from a model's verdict text, one entry a usable line."""
    lines = F.transform(F.split(raw, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda s, i: F.struct(strip(s).alias("s"), i.alias("i")))
    lines = F.filter(lines, lambda x: x["s"].rlike(r"^[0-9]"))
    parts = F.transform(
        lines,
        lambda x: F.struct(
            F.filter(F.transform(F.split(F.regexp_replace(x["s"], r"[|:\t]+", "|"), r"\|"), strip), lambda p: p != "").alias("p"),
            x["i"].alias("i"),
        ),
    )
    parts = F.filter(parts, lambda x: F.size(x["p"]) >= 2)

    def entry(x: Column) -> Column:
        word = F.upper(F.get(x["p"], F.lit(1)))
        verdict = F.when(word.contains("DUP"), "DUPLICATE").when(word.contains("MERGE"), "MERGE").otherwise("KEEP_BOTH")
        verdict = F.when(word.isin("DUPLICATE", "MERGE", "KEEP_BOTH"), word).otherwise(verdict)
        side = F.upper(F.get(x["p"], F.lit(2)))
        keep = F.when((verdict == "DUPLICATE") & side.isin("A", "B"), side)
        return F.struct(F.regexp_extract(F.get(x["p"], F.lit(0)), r"^([0-9]+)", 1).try_cast("int").alias("pair"), verdict.alias("verdict"), keep.alias("keep"), x["i"].alias("line"))

    return F.transform(parts, entry)


def json_repair(c: Column) -> Column:
    """The first text of these that parses as JSON: the unfenced whole, its [...] part, its {...} part; else null."""
    s = strip_fences(c)
    tries = [s, F.regexp_extract(s, r"(?s)(\[.*\])", 1), F.regexp_extract(s, r"(?s)(\{.*\})", 1)]
    # inside brackets, text after a value is an error; the parser alone would pass over it
    return F.coalesce(*[F.when((t != "") & (F.json_array_length(F.concat(F.lit("["), t, F.lit("]"))) == 1) & F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))).isNotNull(), t) for t in tries])


#: Error labels, fixed values.
ERROR_LABELS = {
    "network": "网络中断",
    "timeout": "HTTP超时",
    "limit": "请求限流",
    "server": "服务端错误",
    "auth": "鉴权失败",
    "empty": "响应内容为空",
    "format": "响应格式异常",
    "tokens": "Token超限",
    "address": "API地址错误",
    "unknown": "未知错误",
}
NETWORK_TYPES = ["RemoteDisconnected", "IncompleteRead", "ConnectionResetError", "ConnectionAbortedError", "BrokenPipeError", "ConnectionRefusedError"]


def error_class(kind: Column, code: Column, message: Column, reason: Column | None = None) -> Column:
    """Label of a failure from its exception type, status code, message and (for URL errors) reason."""
    e, m = ERROR_LABELS, F.lower(F.coalesce(message, F.lit("")))
    raw = F.coalesce(message, F.lit(""))
    why = F.lower(F.coalesce(reason, F.lit(""))) if reason is not None else F.lit("")
    code = F.coalesce(code.cast("int"), F.regexp_extract(raw, rf"状态码{SPACE}*([0-9]{{3}})", 1).try_cast("int"))

    def has(*words: str) -> Column:
        out = m.contains(words[0])
        for w in words[1:]:
            out = out | m.contains(w)
        return out

    return (
        F.when(kind.isin(NETWORK_TYPES), e["network"])
        .when(code.isin(524, 504, 408), e["timeout"])
        .when(code == 429, e["limit"])
        .when(code.isin(500, 502, 503, 520), e["server"])
        .when(code.isin(401, 403), e["auth"])
        .when((has("content") & has("null", "缺少", "为空")) | raw.contains("未返回文本"), e["empty"])
        .when(has("json") & has("合法", "解析", "格式"), e["format"])
        .when(has("max_tokens", "stop_reason"), e["tokens"])
        .when(has("dns", "name or service not known", "连接被拒"), e["address"])
        .when((kind == "URLError") & (why.contains("name") | why.contains("resolve") | why.contains("refused")), e["address"])
        .when(has("remotedisconnected", "incompleteread", "connection reset", "connection aborted", "broken pipe"), e["network"])
        .otherwise(e["unknown"])
    )


# --- denoising heuristics for what the extraction prompts ask of a model

TIMESTAMP = r"\[?\(?\b\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?\b\)?\]?"


def drop_timestamps(c: Column) -> Column:
    return F.regexp_replace(c, TIMESTAMP + r" ?", "")


def distinct_lines(c: Column) -> Column:
    """Lines without later repeats, in order; empty lines go."""
    return F.array_join(F.array_distinct(F.filter(F.split(c, "\n"), lambda x: x != "")), "\n")


def drop_fillers(c: Column, fillers: list[str]) -> Column:
    """Filler words that stand as whole words, and the blank after them."""
    words = "|".join(sorted((f.replace(".", r"\.") for f in fillers), key=len, reverse=True))
    return F.regexp_replace(c, rf"(?iU)\b(?:{words})\b,? ?", "")


def correct_terms(c: Column, terms: dict[str, str]) -> Column:
    """Dictionary corrections, applied in the order given."""
    for wrong, right in terms.items():
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return c
