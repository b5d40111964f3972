"""Sign-up submissions: from the address of a GET request to checked records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.texts import form_length, form_length_between
from daybook.operators.computed import with_computed
from daybook.operators.rules import Rule
from daybook.sources.query_strings import all_params, first_param, params

# The choices and length bounds of the form.
GENDERS = ("male", "female", "none")
DEFAULT_GENDER = "male"
EMAIL_DOMAINS = ("direct", "naver.com", "gmail.com", "daum.net")
INTERESTS = ("frontend", "uiux", "backend", "devops")
JOIN_PATHS = ("search", "friend", "sns", "etc")
USER_ID_LENGTH = (4, 15)
PASSWORD_MIN_LENGTH = 8
INTRO_MAX_LENGTH = 200


def read_submissions(urls: DataFrame, url: str) -> DataFrame:
    """Replace the address by the typed form fields. Of the password only the length stays."""
    pairs = urls.withColumn("_params", params(F.col(url)))

    def text(key: str) -> Column:
        return first_param(F.col("_params"), key)

    birth = text("userBirth")
    fields = with_computed(
        pairs,
        userId=text("userId"),
        userPw_len=form_length(text("userPw")),
        userEmail=text("userEmail"),
        emailDomain=text("emailDomain"),
        userName=text("userName"),
        userBirth_text=birth,
        userBirth=F.when(
            birth.rlike(r"^\d{4,}-\d{2}-\d{2}$"), F.try_to_date(birth, "yyyy-MM-dd")
        ),
        gender=F.coalesce(text("gender"), F.lit(DEFAULT_GENDER)),
        interest=all_params(F.col("_params"), "interest"),
        joinPath=F.nullif(text("joinPath"), F.lit("")),
        intro=text("intro"),
    )
    return fields.drop("_params", url)


def _optional(field: str, condition: Column) -> Column:
    return F.col(field).isNull() | (F.col(field) == "") | condition


def form_rules() -> list[Rule]:
    """The rules that the form's fields declare."""
    low, high = USER_ID_LENGTH
    return [
        Rule("userId", "required", "a value is required", F.length("userId") >= 1),
        Rule(
            "userId",
            "length",
            f"{low} to {high} characters",
            _optional("userId", form_length_between(F.col("userId"), low, high)),
        ),
        Rule("userPw_len", "required", "a value is required", F.col("userPw_len") >= 1),
        Rule(
            "userPw_len",
            "length",
            f"at least {PASSWORD_MIN_LENGTH} characters",
            F.coalesce(F.col("userPw_len"), F.lit(0)).isin(0)
            | (F.col("userPw_len") >= PASSWORD_MIN_LENGTH),
        ),
        Rule(
            "emailDomain",
            "choice",
            "one of the given choices",
            F.col("emailDomain").isNull() | F.col("emailDomain").isin(*EMAIL_DOMAINS),
        ),
        Rule("userName", "required", "a value is required", F.length("userName") >= 1),
        Rule(
            "userBirth_text",
            "date",
            "a date as yyyy-MM-dd",
            _optional("userBirth_text", F.col("userBirth").isNotNull()),
        ),
        Rule("gender", "choice", "one of the given choices", F.col("gender").isin(*GENDERS)),
        Rule(
            "interest",
            "choice",
            "one of the given choices",
            F.forall("interest", lambda item: F.coalesce(item.isin(*INTERESTS), F.lit(False))),
        ),
        Rule(
            "joinPath",
            "choice",
            "one of the given choices",
            F.col("joinPath").isNull() | F.col("joinPath").isin(*JOIN_PATHS),
        ),
        Rule(
            "intro",
            "length",
            f"at most {INTRO_MAX_LENGTH} characters",
            F.col("intro").isNull() | (form_length(F.col("intro")) <= INTRO_MAX_LENGTH),
        ),
    ]
