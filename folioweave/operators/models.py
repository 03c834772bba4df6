"""Field extraction by an injected vision model: calls with retries, a second look at the serial number, a fallback.

Each call is an Arrow-batched step that asks only for rows whose condition holds, so nothing is
filtered, joined or shuffled between the steps of a round; what the answers mean is decided in Columns.
A round writes its attempts as a table. The next one reads only the rows that failed or stayed weak, so
no settled row is asked again, and after a lost executor or a killed driver what is written stays.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import scratch
from . import decide as D, fields

log = logging.getLogger("folioweave")

FIELDS = ("serial_number", "epic_number", "elector_name", "relation_type", "relation_name", "house_number", "age", "gender")
SYSTEM = "Extract data exactly as printed. Answer with one JSON object and nothing else."
PROMPT = f"Read the card in the image. Give a JSON object with the keys {', '.join(FIELDS)}; values only, without their printed labels, and null for what is not there. relation_type is father or husband, gender is male or female."
SERIAL_PROMPT = "Read only the serial number in the box at the top left of the card. Give a JSON object with the key serial_number, null if there is none."


def base_address(url: str) -> str:
    """Ends in /v1, once."""
    plain = url.rstrip("/")
    return plain if plain.endswith("/v1") else f"{plain}/v1"


def answer_text(response: dict) -> str:
    """A chat answer's text: a string, or its text parts by line; anything else raises."""
    choices = response.get("choices") or []
    if not choices:
        raise ValueError("the answer holds no choices")
    content = (choices[0].get("message") or {}).get("content")
    if isinstance(content, list):
        content = "\n".join(str(p.get("text") or "") for p in content if isinstance(p, dict) and (p.get("type") == "text" or p.get("text"))) or None
    if not isinstance(content, str):
        raise ValueError("the answer holds no text")
    return content


def chat_client(url: str, key: str, timeout: float = 120, temperature: float = 0.0, max_tokens: int = 256, headers: dict[str, str] | None = None) -> Callable:
    """A factory for ``ask``: each task makes one sender (image bytes, model, prompt) -> text over HTTP."""
    if not url or not key:
        raise ValueError("a model client needs an address and a key")
    address = f"{base_address(url)}/chat/completions"

    def make():
        import base64
        import json
        from urllib.request import Request, urlopen

        def send(image: bytes, model: str, prompt: str) -> str:
            picture = {"url": "data:image/png;base64," + base64.b64encode(image).decode()}
            asked = [{"role": "system", "content": SYSTEM}, {"role": "user", "content": [{"type": "text", "text": prompt}, {"type": "image_url", "image_url": picture}]}]
            body = {"model": model, "messages": asked, "temperature": temperature, "max_tokens": max_tokens}
            sent = Request(address, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}", **(headers or {})})
            with urlopen(sent, timeout=timeout) as got:
                return answer_text(json.load(got))

        return send

    return make


def _wait(message: str, attempt: int) -> float | None:
    """Seconds before another try; None if the failure is not worth one."""
    return D.wait_seconds(message, attempt) if any(m in message.lower() for m in D.RETRYABLE) else None


def ask(df: DataFrame, want: Column, client: Callable, model: str, prompt: str, out: str, tries: int = 3, image: str = "png", patience: float = 1.0) -> DataFrame:
    """Adds ``out`` (answer) and ``out``_error where ``want`` holds, nulls elsewhere.

    A failed call is tried again up to ``tries`` times if its message says that this may help,
    after the time the provider names or a doubling one, times ``patience``. A row with a column
    ``due_`` is not asked before that time. ``out``_at is the time of the last answer.
    """

    def run(batches):
        import time

        import pyarrow as pa

        send = None
        for batch in batches:
            answers, errors, times = [], [], []
            at = batch.schema.get_field_index
            due = batch.column(at("due_")).to_pylist() if at("due_") >= 0 else [None] * batch.num_rows
            for wanted, data, when in zip(batch.column(at("want_")).to_pylist(), batch.column(at(image)).to_pylist(), due):
                answer, error = None, None
                if wanted and when:
                    time.sleep(max(0.0, when - time.time()))
                for attempt in range(1, tries + 1) if wanted else ():
                    try:
                        send = send or client()
                        answer, error = send(data, model, prompt), None
                        break
                    except Exception as e:  # noqa: BLE001 - the row reports it
                        error = f"{type(e).__name__}: {e}"
                        pause = _wait(str(e), attempt)
                        if pause is None or attempt == tries:
                            break
                        time.sleep(pause * patience)
                answers.append(answer)
                errors.append(error)
                times.append(time.time() if wanted else None)
            kept = [n for n in batch.schema.names if n != "want_"]
            yield pa.RecordBatch.from_arrays([*(batch.column(at(n)) for n in kept), pa.array(answers, pa.string()), pa.array(errors, pa.string()), pa.array(times, pa.float64())], [*kept, out, f"{out}_error", f"{out}_at"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.withColumn("want_", F.coalesce(want, F.lit(False))).mapInArrow(run, f"{kept}, {out} string, {out}_error string, {out}_at double")


def payload(answer: Column) -> Column:
    """struct of text fields of the JSON object in an answer; null if there is none."""
    carved = D.carved_json(answer)
    read = F.from_json(carved, ", ".join(f"{n} string" for n in FIELDS))
    return F.when(F.get_json_object(carved, "$").isNotNull(), read)


def _looked_at(df: DataFrame, todo: Column, client, model: str, name: str, tries: int, image: str, patience: float) -> DataFrame:
    """Adds struct ``name`` (payload, issue, error) of one model: a first look, and one for a missing serial number."""
    df = ask(df, todo, client, model, PROMPT, "a_", tries, image, patience).withColumn("p_", payload(F.col("a_")))
    df = ask(df, F.col("p_").isNotNull() & D.optional(F.col("p_.serial_number")).isNull(), client, model, SERIAL_PROMPT, "s_", tries, image, patience)
    second = payload(F.col("s_"))
    bad = lambda a, p: F.when(F.col(a).isNotNull() & p.isNull(), "ValueError: the answer holds no JSON object")
    error = F.coalesce("a__error", bad("a_", F.col("p_")), "s__error", bad("s_", second))
    serial = F.coalesce(D.optional(F.col("p_.serial_number")), D.optional(second["serial_number"]), F.col("p_.serial_number"))
    merged = F.when(F.col("p_").isNotNull(), F.struct(serial.alias("serial_number"), *(F.col(f"p_.{n}").alias(n) for n in FIELDS[1:])))
    issue = F.when(F.col("p_").isNotNull(), D.quality_issue({n: merged[n] for n in FIELDS}))
    last = F.greatest("a__at", "s__at")
    return df.withColumn(name, F.struct(merged.alias("payload"), issue.alias("issue"), error.alias("error"), last.alias("at"))).drop("a_", "a__error", "a__at", "p_", "s_", "s__error", "s__at")


def attempted(df: DataFrame, number: int, client: Callable, model: str, fallback: str | None, tries: int, image: str, patience: float) -> DataFrame:
    """Adds attempt, payload, model, error and due (when a failed row may be asked again) of one round.

    The model's payload counts if it has no quality issue. Else the fallback model is asked, and
    the sound, or else the fuller, payload is taken; of equal ones the first. It is judged once more:
    what is still weak is an error like any other.
    """
    full = lambda c: D.completeness({n: F.col(f"{c}.payload.{n}") for n in FIELDS})
    df = _looked_at(df, F.lit(True), client, model, "first_", tries, image, patience)
    error, chosen, issue, name, at = F.col("first_.error"), F.col("first_.payload"), F.col("first_.issue"), F.lit(model), F.col("first_.at")
    if fallback and fallback != model:
        weak = error.isNull() & issue.isNotNull()
        df = _looked_at(df, weak, client, fallback, "second_", tries, image, patience)
        second = F.coalesce(weak & F.col("second_.payload").isNotNull() & (F.col("second_.issue").isNull() | (full("second_") > full("first_"))), F.lit(False))
        of = lambda field, other: F.when(second, F.col(f"second_.{field}")).otherwise(other)
        error, at = F.coalesce(error, F.col("second_.error")), F.greatest(at, F.col("second_.at"))
        chosen, issue, name = of("payload", chosen), of("issue", issue), F.when(second, F.lit(fallback)).otherwise(name)
    df = df.withColumn("error", F.coalesce(error, F.concat(F.lit("ValueError: Low-quality extraction: "), issue)))
    good = F.col("error").isNull()
    df = df.withColumns({"attempt": F.lit(number), "payload": F.when(good, chosen), "model": F.when(good, name), "due": F.when(~good, at + patience * D.retry_delay(F.col("error"), F.lit(number)))})
    return df.drop("first_", "second_", "due_")


def best_payloads(df: DataFrame, client: Callable, model: str, fallback: str | None = None, tries: int = 3, rounds: int = 3, image: str = "png", patience: float = 1.0, key: tuple[str, ...] | None = None, folder: str | None = None) -> DataFrame:
    """Adds payload (text fields), model and error to df.

    Runs up to ``rounds`` (at least ``tries``) rounds at once and writes each as attempt=<n> into
    ``folder`` (one of its own in the shared folder if none is named; a folder with rounds that an
    earlier run finished is gone on with). ``key`` names columns, never null, that tell rows apart;
    without it df is first written with numbers. A row that fails or is weak in every round keeps its last error.
    """
    spark = df.sparkSession
    folder = folder or scratch.new_folder(spark)
    kept = [c for c in df.columns if c not in ("payload", "model", "error")]
    df = df.select(*(F.col(f"`{c}`") for c in kept))
    if key is None:
        df, key = scratch.numbered(df, f"{folder}/rows", "row_"), ("row_",)
    key = list(key)
    tables: list[DataFrame] = []
    total = max(rounds, tries, 1)
    for n in range(1, total + 1):
        todo = df.select(*key, image)
        if tables:
            todo = todo.join(tables[-1].where("error is not null").select(*key, F.col("due").alias("due_")), key)
        tables.append(scratch.once(attempted(todo, n, client, model, fallback, tries, image, patience).drop(image), f"{folder}/attempt={n}"))
        failed = tables[-1].where("error is not null").count()
        if failed:
            log.warning("extraction attempts failed", extra={"attempt": n, "max_attempts": total, "crops": failed})
        else:
            break
    answers = reduce(DataFrame.unionByName, [t.where("error is null") for t in tables[:-1]] + [tables[-1]])
    return df.join(answers.select(*key, "payload", "model", "error"), key).select(*(F.col(f"`{c}`") for c in kept), "payload", "model", "error")


def attempts(spark, folder: str) -> DataFrame:
    """All attempts in a folder of best_payloads: the key, attempt, payload, model, error and due."""
    import itertools

    paths = itertools.takewhile(lambda p: scratch.written(spark, p), (f"{folder}/attempt={n}" for n in itertools.count(1)))
    return reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in paths])


def extracted(df: DataFrame, client: Callable, model: str, fallback: str | None = None, **how) -> DataFrame:
    """best_payloads with typed fields in place of the payload, and raw_text (the payload as JSON).

    An invalid field makes an error here, after all tries.
    """
    got = best_payloads(df, client, model, fallback, **how)
    typed = fields.typed({n: F.col(f"payload.{n}") for n in FIELDS})
    got = got.withColumn("typed_", typed).withColumn("error", F.coalesce("error", "typed_.error"))
    return got.select("*", *(F.col(f"typed_.{n}").alias(n) for n in FIELDS), F.to_json("payload", {"ignoreNullFields": "false"}).alias("raw_text")).drop("typed_", "payload")
