"""Entities of short texts by rule tables, and how alike two sets of entities are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, bounded, bounded_name

# Names and the keys that they stand for.
ORGANISATIONS = {
    "openai": "openai", "anthropic": "anthropic", "google": "google", "deepmind": "google-deepmind", "google deepmind": "google-deepmind",
    "meta": "meta", "microsoft": "microsoft", "nvidia": "nvidia", "mistral": "mistral", "hugging face": "huggingface", "huggingface": "huggingface",
    "xai": "xai", "apple": "apple", "amazon": "amazon", "aws": "amazon", "ibm": "ibm", "cohere": "cohere", "stability ai": "stability",
    "perplexity": "perplexity", "databricks": "databricks", "deepseek": "deepseek", "alibaba": "alibaba", "baidu": "baidu", "tencent": "tencent",
    "bytedance": "bytedance", "moonshot": "moonshot", "groq": "groq", "cerebras": "cerebras", "together ai": "together", "scale ai": "scale",
    "runway": "runway", "midjourney": "midjourney", "figure": "figure", "tesla": "tesla", "salesforce": "salesforce", "oracle": "oracle",
    "intel": "intel", "amd": "amd", "arm": "arm", "qualcomm": "qualcomm", "eu": "eu", "european union": "eu",
}
PRODUCTS = ("copilot", "chatgpt", "cursor", "pytorch", "tensorflow", "jax", "cuda", "vllm", "ollama", "langchain", "transformers", "kubernetes")
MODEL_FAMILIES = (
    "gpt", "claude", "gemini", "gemma", "llama", "mistral", "mixtral", "qwen", "deepseek", "phi", "grok", "sora", "dall-e", "dalle", "whisper", "flux",
    "midjourney", "stable diffusion", "codestral", "command", "nova", "titan", "falcon", "yi", "kimi", "ernie", "olmo", "pythia", "bert", "clip", "sam",
    "veo", "imagen", "willow", "nemotron", "granite", "jamba", "smollm",
)
STOP_ACRONYMS = (
    "THE", "AND", "FOR", "NEW", "NOW", "WITH", "HOW", "WHY", "ALL", "ONE", "TWO", "TOP", "CAN", "VIA", "IT", "US", "UK", "USA",
    "AI", "ML", "LLM", "LLMS", "NLP", "RAG", "SOTA", "API", "APIS", "SDK", "GPU", "GPUS", "CPU", "DATA", "OPEN", "CEO", "CTO", "COO",
)
# How much a shared entity says, by kind.
WEIGHTS = {"product": 0.7, "model": 0.6, "term": 0.6, "org": 0.25}
VERSIONED_WEIGHT, OTHER_WEIGHT = 1.0, 0.4
GATE_WEIGHT, DECISIVE_WEIGHT = 0.5, 1.0
SUMMARY_CHARS = 400


def _mentioned(words: Column, names: list[tuple[str, str]]) -> Column:
    """The values of all names that occur as whole words."""
    table = F.array(*[F.struct(F.lit(bounded_name(n)).alias("name"), F.lit(k).alias("key")) for n, k in names])
    return bound(words, lambda w: F.transform(F.filter(table, lambda e: F.contains(w, e["name"])), lambda e: e["key"]))


def extract_entities(text: Column) -> Column:
    """Distinct sorted keys: org:, product:, model: (families and versions) and term: (acronyms)."""
    t = F.coalesce(text, F.lit(""))
    words = bounded(t)
    named = [(n, f"org:{k}") for n, k in ORGANISATIONS.items()] + [(n, f"product:{n}") for n in PRODUCTS] + [(n, f"model:{n}") for n in MODEL_FAMILIES]
    joined = "|".join(sorted(MODEL_FAMILIES, key=len, reverse=True))
    versioned = rf"(?i)(?<![\p{{L}}\p{{N}}_])(?:{joined})[\s\-]?\d+(?:\.\d+)*(?![\p{{L}}\p{{N}}_])"
    hits = F.transform(F.regexp_extract_all(t, F.lit(versioned), F.lit(0)), F.lower)
    family = lambda h: F.regexp_extract(h, rf"^({joined})", 1)
    version = lambda h: F.regexp_extract(h, r"(\d+(?:\.\d+)*)$", 1)
    whole = F.transform(hits, lambda h: F.concat(F.lit("model:"), family(h), F.lit("-"), version(h)))
    bare = F.transform(hits, lambda h: F.concat(F.lit("model:"), family(h)))
    terms = F.regexp_extract_all(t, F.lit(r"(?<![\p{L}\p{N}_])[A-Z]{2,6}(?![\p{L}\p{N}_])"), F.lit(0))
    terms = F.transform(F.filter(terms, lambda a: ~a.isin(*STOP_ACRONYMS)), lambda a: F.concat(F.lit("term:"), F.lower(a)))
    return F.array_sort(F.array_distinct(F.concat(_mentioned(words, named), whole, bare, terms)))


def article_entities(title: Column, summary: Column) -> Column:
    return F.array_sort(F.array_union(extract_entities(title), extract_entities(F.left(summary, F.lit(SUMMARY_CHARS)))))


def is_versioned(entity: Column) -> Column:
    """A family with a version; a family whose own name has a hyphen is not one."""
    hyphened = [f"model:{f}" for f in MODEL_FAMILIES if "-" in f]
    return F.startswith(entity, F.lit("model:")) & F.contains(entity, F.lit("-")) & ~entity.isin(*hyphened)


def weight(entity: Column) -> Column:
    out = F.when(is_versioned(entity), F.lit(VERSIONED_WEIGHT))
    for kind, value in WEIGHTS.items():
        out = out.when(F.startswith(entity, F.lit(kind + ":")), F.lit(value))
    return out.otherwise(F.lit(OTHER_WEIGHT))


def _total(entities: Column) -> Column:
    return F.aggregate(entities, F.lit(0.0), lambda s, e: s + weight(e))


def weighted_overlap(a: Column, b: Column) -> Column:
    """The weight of the shared entities by that of all; 0 if either is empty."""
    whole = _total(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0) | (whole == 0), F.lit(0.0)).otherwise(_total(F.array_intersect(a, b)) / whole)


def strongest_shared(a: Column, b: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(F.array_intersect(a, b), weight)), F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    whole = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / whole)


def has_conflicting_version(a: Column, b: Column) -> Column:
    """A family on both sides with versions on both, none of them shared."""
    pick = lambda s: F.filter(s, is_versioned)
    family = lambda v: F.regexp_replace(v, r"-\d+(?:\.\d+)*$", "")
    va, vb = pick(a), pick(b)
    both = F.array_intersect(F.transform(va, family), F.transform(vb, family))
    of = lambda v, f: F.filter(v, lambda x: family(x) == f)
    apart = lambda v: F.exists(v["both"], lambda f: ~F.arrays_overlap(of(v["a"], f), of(v["b"], f)))
    return bound(F.struct(va.alias("a"), vb.alias("b"), both.alias("both")), apart)
