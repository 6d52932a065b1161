"""Generation behind a provider: prompts, answers, validation, one repair, acceptance.

A provider is called with a list of prompts and gives as many answers; an exception for a batch becomes an error on its
rows. Each distinct prompt is asked once (``ledger``); all else is deterministic.
"""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import fixed
from ..operators import qa
from . import ledger

Provider = Callable[[list[str]], list[str]]


@dataclass(frozen=True)
class ChatEndpoint:
    """A chat completion service; a cut-off answer is asked for once more with room for 1.8 times the tokens."""

    url: str
    model: str
    key: str = ""
    max_tokens: int = 2048
    timeout: float = 300.0

    def _ask(self, prompt: str, tokens: int) -> tuple[str, str]:
        body = {"model": self.model, "temperature": 0, "max_tokens": tokens, "messages": [{"role": "user", "content": prompt}]}
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        url = self.url.rstrip("/")
        url = url if url.endswith("/chat/completions") else f"{url}/chat/completions"
        with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), headers), timeout=self.timeout) as r:
            choice = json.load(r)["choices"][0]
        return choice["message"]["content"] or "", choice.get("finish_reason", "")

    def __call__(self, prompts: list[str]) -> list[str]:
        out = []
        for p in prompts:
            text, why = self._ask(p, self.max_tokens)
            out.append(self._ask(p, int(1.8 * self.max_tokens))[0] if why == "length" else text)
        return out


def echo_provider(prompts: list[str]) -> list[str]:
    """A stand-in without a network: the prompt's last paragraph."""
    return [p.rstrip().rpartition("\n\n")[2] for p in prompts]


def prompt(snapshot_json: Column, evidence: Column | None = None, examples: str = "", contract: str = "", focus: Column | None = None) -> Column:
    """Examples, format, focus, evidence and snapshot, each a paragraph if there is one."""
    parts = [F.lit(examples or None).cast("string"), F.lit(contract or None).cast("string"), focus, evidence, snapshot_json]
    return F.concat_ws("\n\n", *[p for p in parts if p is not None])


def evidence_block(hits: Column, most_chars: int = 800) -> Column:
    """Numbered passages with their locators, from an array of structs of locator and text."""
    return F.array_join(F.transform(hits, lambda h, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), F.coalesce(h["locator"], F.lit("")), F.lit(" "), F.left(h["text"], F.lit(most_chars)))), "\n")


def complete(rows: DataFrame, column: str, provider: Provider, out: str = "answer", batch: int = 16, **calls) -> DataFrame:
    """``rows`` with the provider's answer to the prompt in ``column`` and an error text if the call failed.

    Each distinct prompt is asked once (``ledger.once``, which takes ledger, lanes and per_second from ``calls``) and its
    answer is written before it is used.
    """
    name = calls.pop("name", getattr(provider, "model", type(provider).__name__))
    answers = ledger.once(rows.select(F.col(column).alias("request")), provider, name, batch=batch, **calls)
    return ledger.joined(rows, column, answers, name, out)


def generate(rows: DataFrame, provider: Provider, valid: Callable[[Column], Column] = qa.strict_v2, repair: Callable[[Column], Column] | None = None, **calls) -> DataFrame:
    """Answers to ``prompt``; those that are not valid get one repair; what is still not valid is NULL with a reason.

    Answers come from the ledger's written table, so both sides of the repair see the same ones. ``calls`` is ``complete``'s.
    """
    judged = lambda df: df.withColumn("answer", qa.final_qa(F.col("answer"))).withColumn("is_valid", F.coalesce(valid(F.col("answer")), F.lit(False)))
    first = judged(complete(rows, "prompt", provider, **calls))
    if repair is not None:
        good, bad = first.filter("is_valid"), first.filter("not is_valid")
        again = complete(bad.withColumn("prompt", repair(F.col("answer"))).drop("answer", "error", "is_valid"), "prompt", provider, **calls)
        first = good.unionByName(judged(again))
    reason = qa.failure(F.col("error").isNotNull(), F.trim("answer") != "", F.contains("answer", F.lit(qa.LABELS.guideline)), F.col("is_valid"), F.lit(True))
    return first.withColumn("invalid_reason", F.when(~F.col("is_valid"), reason)).withColumn("answer", F.when(F.col("is_valid"), F.col("answer")))


# Wording of prompts; another wording may take its place.
MILD, STEADY, ACTIVE = "a mild adjustment within maintenance", "maintenance and an assessment of the state, not an emergency", "a decision to act now"
FOCUS = "The question is about {}: it states background and signals alone, without any interpretation, and asks what to do."


def focus(kind: Column, key: Column, delta: Column, smoothed_delta: Column) -> Column:
    """What a question should be about, by the kind and the size of what was done."""
    small = (key.endswith("_RATE") & (F.abs(delta) < 1.0)) | (key.endswith("_VOL") & (smoothed_delta < 1.0))
    mild = (kind == "rate_adjustment") & F.coalesce(small, F.lit(False))
    what = F.when(mild, MILD).when(kind.isin("continuous_infusion", "unlabeled_context_snapshot"), STEADY).otherwise(ACTIVE)
    before, after = FOCUS.split("{}")
    return F.concat(F.lit(before), what, F.lit(after))


def example_for(kind: Column, examples: dict[str, str], default: str = "continuous_infusion") -> Column:
    """The worked example of a kind, that of the default kind for any other."""
    known = F.create_map(*[F.lit(x) for pair in examples.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.coalesce(kind, F.lit(default))), F.lit(examples.get(default, "")))


def contract(labels: qa.Labels = qa.LABELS, quotes: bool = True) -> str:
    """The format that an answer must have, line by line."""
    third = f"{labels.guideline}：{qa.DIAGNOSIS}：<signals>; {qa.ACTION}：<drug, dose, unit, when to look again, what next>" + (f'; {qa.QUOTE}："<words of the evidence>" <locator>' if quotes else "")
    lines = ["Q: <background, signals and trends, ending in a question for the intervention>", f"A: {labels.reason[0]}：<one to three sentences>", third, f"{labels.logged}：<drug, direction, number and unit as they were given>"]
    return "Answer with exactly these four lines and nothing else:\n" + "\n".join(lines)


def targets(actual: Column, key: Column, words: Column, unit: Column, value: Column) -> Column:
    """What was done, as far as an answer must keep to it."""
    number = F.when(unit.isNotNull() & value.isNotNull(), F.concat(F.lit("\n- its number: "), fixed(value, 2), F.lit(" "), unit)).otherwise("")
    said = F.when(F.size(words) > 0, F.array_join(words, ", ")).otherwise("N/A")
    return F.concat(F.lit("The last line keeps to what was done, without saying so:\n- action: "), F.coalesce(actual, F.lit("")), F.lit("\n- key: "), F.coalesce(key, F.lit("")), F.lit("\n- words for the drug: "), said, number)


def repair_prompt(answer: Column, goal: Column, labels: qa.Labels = qa.LABELS, payload: bool = False) -> Column:
    """A prompt that asks for an answer once more in its format, or as a JSON object of its parts with ``payload``."""
    form = 'Answer with JSON only: {"question": "", "reasoning": "", "miller_decision": "", "vitaldb_decision": "", "final_output": ""}' if payload else contract(labels)
    return F.concat_ws("\n\n", F.lit("Rewrite the text below without any thoughts, lists, headings or remarks."), F.lit(form), goal, F.concat(F.lit("Text:\n"), F.coalesce(answer, F.lit(""))))


def web_block(hits: Column, most: int = 5, most_chars: int = 500) -> Column:
    """Numbered web hits from an array of structs of title, url and snippet; '' without any."""
    line = lambda h, i: F.concat(F.lit("[Web "), (i + 1).cast("string"), F.lit("] "), F.coalesce(h["title"], F.lit("")), F.lit(" | "), F.coalesce(h["url"], F.lit("")), F.lit(" | "), F.left(F.coalesce(h["snippet"], F.lit("")), F.lit(most_chars)))
    return F.array_join(F.transform(F.slice(hits, 1, most), line), "\n")


def _json(url: str, body: dict | None, timeout: float) -> dict:
    data = None if body is None else json.dumps(body).encode()
    with urllib.request.urlopen(urllib.request.Request(url, data, {"Content-Type": "application/json"}), timeout=timeout) as r:
        return json.load(r)


@dataclass(frozen=True)
class WebSearch:
    """A search service for ``search``: tavily, serpapi, or one of your own that takes query, top_k and domains.

    ``call`` is (url, body or None, timeout) -> dict and stands in for the network in tests.
    """

    provider: str
    key: str = ""
    url: str = ""
    top_k: int = 5
    domains: tuple[str, ...] = ()
    timeout: float = 20.0
    call: Callable[[str, dict | None, float], dict] = _json

    def _items(self, query: str) -> list:
        top = max(1, self.top_k)
        if self.provider in ("tavily", "serpapi") and not self.key:
            raise ValueError(f"missing API key for {self.provider}")
        if self.provider == "tavily":
            body = {"api_key": self.key, "query": query, "max_results": top, "search_depth": "advanced", "include_answer": False, "include_raw_content": False}
            return self.call("https://api.tavily.com/search", body | ({"include_domains": list(self.domains)} if self.domains else {}), self.timeout).get("results")
        if self.provider == "serpapi":
            asked = urllib.parse.urlencode({"engine": "google", "q": query, "api_key": self.key, "num": top})
            return (self.call(f"https://serpapi.com/search.json?{asked}", None, self.timeout).get("organic_results") or [])[:top]
        if self.provider == "custom":
            if not self.url:
                raise ValueError("a custom search needs a url")
            return (self.call(self.url, {"query": query, "top_k": top, "domains": list(self.domains)}, self.timeout).get("results") or [])[:top]
        raise ValueError(f"unsupported provider: {self.provider}")

    def __call__(self, query: str) -> list[dict]:
        text = lambda h, *names: next((str(h[n]).strip() for n in names if h.get(n)), "")
        found = [h for h in self._items(query) or [] if isinstance(h, dict)]
        return [{"title": text(h, "title"), "url": text(h, "url", "link"), "snippet": text(h, "snippet", "content"), "score": float(h.get("score") or 0.0), "provider": self.provider} for h in found]


HIT = "title string, url string, snippet string, score double, provider string"


def search(queries: DataFrame, provider: Callable[[str], list[dict]], **calls) -> DataFrame:
    """Web results per (query_id, query): rank, title, url, snippet, score, and an error row if the call failed.

    Each distinct query is searched once; ``calls`` is ``ledger.once``'s.
    """
    name = calls.pop("name", getattr(provider, "provider", type(provider).__name__))
    found = lambda some: [[{**{n: h.get(n) for n in ("title", "url", "snippet", "provider")}, "score": float(h.get("score") or 0.0)} for h in provider(q)] for q in some]
    answers = ledger.once(queries.select(F.col("query").alias("request")), found, name, **{"batch": 1, **calls})
    rows = ledger.joined(queries.select("query_id", "query"), "query", answers, name, "answer")
    hits = rows.select("query_id", "error", F.posexplode_outer(F.from_json("answer", f"array<struct<{HIT.replace(' ', ':').replace(',:', ', ')}>>")).alias("at", "hit"))
    return hits.filter("hit is not null or error is not null").select("query_id", (F.col("at") + 1).cast("int").alias("rank"), *[f"hit.{n}" for n in ("title", "url", "snippet", "score", "provider")], "error")
