"""JSON documents as typed columns that keep every digit of the source text."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The keys the extract reads.
LINE_KEYS = """
    serviceLineNumber internalControlNumber cmsServiceDate
    healthCareServiceLocationFacilityCode healthcareCommonProcedureCode
    healthcareCommonProcedureCodeModifiers billedAmount allowedAmount
    paidToProviderAmount paidToBeneficiaryAmount appliedToDeductibleAmount
    coinsuranceAmount cutbackAmounts renderingProviderNpi renderingProviderPtan
    renderingProviderSpecialtyCode providerServiceLineId
    serviceFacilityLocationLastOrOrganizationName
    serviceFacilityLocationAddressLine1 serviceFacilityLocationCity
    serviceFacilityLocationState serviceFacilityLocationZipCode
""".split()

CLAIM_KEYS = """
    macId receiptDate planCode internalControlNumber beneficiaryLastName
    beneficiaryFirstName beneficiaryGender billingProviderNpi billingProviderEin
    billingProviderTinType totalAllowedAmount totalCoinsuranceAmount
    totalBilledAmount serviceStartDate serviceEndDate providerTaxonomyCode
    referringProviderNpi billingProviderPtan regularDeductibleAmountMet
    submitterId patientControlNumber patientPaidAmount
    medicareBeneficiaryIdentifier isParticipatingProvider
""".split()

BENE_CHECK_KEYS = """
    checkNumber checkStatus claimAmount beneHicNumber checkIssueDate
    checkStatusDate claimInterestAmount claimRecoupmentAmount
    couldNotBeForwarded higlasClaimCheckNumber
""".split()

PROVIDER_CHECK_KEYS = [key for key in BENE_CHECK_KEYS if key != "beneHicNumber"]


def _texts(keys) -> T.StructType:
    return T.StructType([T.StructField(key, T.StringType()) for key in keys])


# Every scalar is read as text: amounts must not lose trailing zeros, and a
# flag or number given as JSON text must not turn into NULL.
LINE_SCHEMA = _texts(LINE_KEYS).add("diagnosisCodes", T.ArrayType(T.StringType()))

# A line value may also sit on the claim, under the same key.
CLAIM_SCHEMA = (
    _texts(CLAIM_KEYS + [key for key in LINE_KEYS if key not in CLAIM_KEYS])
    .add("diagnosisCodes", T.ArrayType(T.StringType()))
    .add("serviceLines", T.ArrayType(LINE_SCHEMA))
)

# What selecting and counting claims needs; one key is enough to count lines.
CLAIM_KEY_SCHEMA = _texts(["macId", "receiptDate"]).add(
    "serviceLines", T.ArrayType(_texts(["serviceLineNumber"]))
)

# The lines as text, so that each is parsed by itself.
_LINE_TEXTS = T.StructType().add("serviceLines", T.ArrayType(T.StringType()))

PAYMENT_SCHEMA = (
    _texts(["interestRate", "interestDaysOver"])
    .add("beneCheck", _texts(BENE_CHECK_KEYS))
    .add("providerCheck", _texts(PROVIDER_CHECK_KEYS))
)

# A JSON number after a key, or an array of numbers only.  A key is the one
# place where a whole quoted word is followed by a colon, so text that merely
# looks like this inside a value has escaped quotes and does not match.  The search runs
# from colon to colon and looks back at the key only where a number follows, as trying
# a key at each quote takes most of a parse; so a key has at most 200 characters, and so many blanks before its colon.
_NUMBERS = r"-?[0-9][0-9.eE+-]*|\[[\s0-9.,eE+-]*[0-9][\s0-9.,eE+-]*\]"
_NUMBER_NEXT = rf'(?=\s*+(?:{_NUMBERS}))(?<="(?!diagnosisCodes")\w{{1,200}}"\s{{0,200}}:)'
_BARE_NUMBERS = rf"\G((?:[^:]*+:(?!{_NUMBER_NEXT}))*+[^:]*+:\s*)({_NUMBERS})"


# A bare number in an array of codes: behind the key, or behind the one before.
_BARE_CODES = (
    r'((?:"diagnosisCodes"\s*:\s*\[|(?<!^)\G\s*,)\s*(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*,\s*)*+)'
    r"(-?[0-9][0-9.eE+-]*)"
)
# The first of them, which is always behind the key. A pattern that begins with plain text is found fast.
_FIRST_BARE_CODE = r'"diagnosisCodes"\s*:\s*\[\s*(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"\s*,\s*)*+-?[0-9]'


# A value within ``NESTING`` levels of brackets. Repeats are possessive, so the pattern takes each character once and
# its text grows by one copy of its parts a level; values nested deeper are read as the parser gives them.
NESTING = 16
_QUOTED = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _nested(levels: int) -> str:
    inner = f"|{_nested(levels - 1)}" if levels > 1 else ""
    return rf'[\[{{](?:[^\[\]{{}}"]++|{_QUOTED}{inner})*+[\]}}]'


# An object, or an array of more than texts only or numbers only, under a key that is read as text.
_PLAIN_ARRAY = rf"\[\s*(?:{_QUOTED}\s*(?:,\s*{_QUOTED}\s*)*+)?\]|\[[\s0-9.,eE+-]*\]"
_TEXT_KEY = r'"(?!(?:serviceLines|diagnosisCodes|beneCheck|providerCheck)")\w+"\s*:\s*'
_NESTED_TEXT = rf"({_TEXT_KEY})(?!{_PLAIN_ARRAY})({_nested(NESTING)})"
# Matches a text, whole and fast, in which ``_NESTED_TEXT`` does not match: each colon is behind one of the other keys,
# or before a plain array or what is no object or array.
_OTHER_KEY = r'(?<!"(?:serviceLines|diagnosisCodes|beneCheck|providerCheck)":)'
_NOT_NESTED = rf"\A(?:[^:]*+:(?!(?=\s*+[\[{{]){_OTHER_KEY}\s*+(?!{_PLAIN_ARRAY})))*+[^:]*+\z"


def nested_as_text(document: Column) -> Column:
    """Nested values under keys that are read as text become JSON strings of their source text, byte for byte.

    The parser would write them anew and lose digits. The document is cut at those values and put together again
    with each of them quoted; most documents have none and stay as they are.
    """
    between = F.split(document, _NESTED_TEXT)
    key = F.regexp_extract_all(document, F.lit(_NESTED_TEXT), F.lit(1))
    value = F.regexp_extract_all(document, F.lit(_NESTED_TEXT), F.lit(2))
    escaped = lambda x: F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    one_line = lambda x: F.regexp_replace(x, r"[\n\r\t]", " ")
    quoted = F.zip_with(key, value, lambda k, v: F.concat(k, F.lit('"'), escaped(one_line(v)), F.lit('"')))
    rebuilt = F.zip_with(between, quoted, lambda text, v: F.concat(text, F.coalesce(v, F.lit(""))))
    found = ~document.rlike(_NOT_NESTED) & document.rlike(_NESTED_TEXT)
    return F.when(found, F.array_join(rebuilt, "")).otherwise(document)


def keep_digits(document: Column) -> Column:
    """Quote bare numbers, so that ``100.50`` is read as the text ``100.50``, and nested values as written."""
    numbers = F.regexp_replace(nested_as_text(document), _BARE_NUMBERS, '$1"$2"')
    # The one-element array binds the text, which is then made once.
    return F.transform(F.array(numbers), _quoted_codes)[0]


def _quoted_codes(text: Column) -> Column:
    return F.when(text.rlike(_FIRST_BARE_CODE), F.regexp_replace(text, _BARE_CODES, '$1"$2"')).otherwise(text)


def parse_claim(document: Column) -> Column:
    """The typed claim; an element of the lines that is no object is a line without values.

    Such an element leaves the whole array NULL; only then the elements are parsed one by one.
    """
    digits = keep_digits(document)
    none = F.from_json(F.lit("{}"), LINE_SCHEMA)
    line = lambda text: F.coalesce(F.from_json(text, LINE_SCHEMA), none)

    def whole(claim: Column) -> Column:
        lost = claim["serviceLines"].isNull() & document.contains('"serviceLines"')
        one_by_one = F.transform(F.from_json(digits, _LINE_TEXTS)["serviceLines"], line)
        return F.when(lost, claim.withField("serviceLines", one_by_one)).otherwise(claim)

    # The one-element array binds the parsed claim, which is then parsed once.
    return F.transform(F.array(F.from_json(digits, CLAIM_SCHEMA)), whole)[0]


# Where the parser puts a document that it finds fault with.
_CORRUPT = "_corrupt_record"


def parse_claim_values(document: Column, keys=(), line_keys=()) -> Column:
    """``parse_claim`` with the values of ``keys`` alone, and of ``line_keys`` in its lines.

    Few keys have only the numbers behind them quoted, and the parser steps over all other values. A document that the parser
    finds fault with, or of which a wanted text is nested, is parsed whole; so its values are those of ``parse_claim``
    (which loses a document with an array of numbers over several lines; here it is lost only where that array is wanted).
    """
    pick = lambda schema, names: T.StructType([schema[name] for name in names])
    schema = pick(CLAIM_SCHEMA, keys)
    if line_keys:
        schema = schema.add("serviceLines", T.ArrayType(pick(LINE_SCHEMA, line_keys)))
    read = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    quoted, texts = document, sorted({*keys, *line_keys} - {"diagnosisCodes"})
    # A pattern for one key begins with plain text and is found fast, in a tenth of the time that one for all keys takes.
    if len(texts) > 8:
        quoted = F.regexp_replace(document, _BARE_NUMBERS, '$1"$2"')
    else:
        for name in texts:
            quoted = F.regexp_replace(quoted, rf'"{name}"\s{{0,200}}:\s*+({_NUMBERS})', f'"{name}":"$1"')
    if "diagnosisCodes" in (*keys, *line_keys):
        quoted = F.transform(F.array(quoted), _quoted_codes)[0]
    only = lambda value, names: F.struct(*[value[name].alias(name) for name in names])
    lines_of = lambda claim: F.transform(claim["serviceLines"], lambda line: only(line, line_keys)).alias("serviceLines")
    few = lambda claim: F.struct(*[claim[key].alias(key) for key in keys], *[lines_of(claim)] * bool(line_keys))
    nested = lambda value: (value.startswith("[") | value.startswith("{")) & ~value.rlike(rf"\A(?:{_PLAIN_ARRAY})\z")
    any_nested = lambda of, names: [nested(of[name]) for name in names if name != "diagnosisCodes"]

    def settled(claim: Column) -> Column:
        odd = [claim[_CORRUPT].isNotNull(), *any_nested(claim, keys)]
        if any(name != "diagnosisCodes" for name in line_keys):
            odd.append(F.exists(claim["serviceLines"], lambda line: reduce(or_, any_nested(line, line_keys))))
        whole = F.transform(F.array(parse_claim(document)), few)[0]
        return F.when(reduce(or_, odd), whole).otherwise(only(claim, schema.names))

    # The one-element array binds the parsed claim, which is then parsed once.
    return F.transform(F.array(F.from_json(quoted, read, {"columnNameOfCorruptRecord": _CORRUPT})), settled)[0]


def line_count(lines: Column, document: Column) -> Column:
    """Elements of the lines as parsed, or where an odd one left them NULL, as written."""
    written = F.json_array_length(F.get_json_object(document, "$.serviceLines"))
    return F.coalesce(F.size(lines), written).cast("bigint")


def parse_claim_key(document: Column) -> Column:
    return F.from_json(document, CLAIM_KEY_SCHEMA)


def parse_payment(document: Column) -> Column:
    return F.from_json(keep_digits(document), PAYMENT_SCHEMA)


def spaced_json(text: Column) -> Column:
    """Array or object text with one blank after each ``,`` and ``:``.

    Blanks and separators inside quoted strings stay as they are.
    """
    # Nested values come as they were written, with whatever blanks there were.
    compact = F.regexp_replace(text, rf'\G((?:[^"\s]|{_QUOTED})*+)\s', "$1")
    spaced = F.regexp_replace(compact, rf'\G((?:[^",:]|{_QUOTED})*+)([,:])', "$1$2 ")
    return F.when(text.rlike(r"^[\[{]"), spaced).otherwise(text)
