"""JSON values as variants: their kinds as read, and fields of an object, as SQL expressions."""


def kind(value: str) -> str:
    """Type of a JSON value: object, array, string, integer, number, boolean or null; SQL null if absent.

    A number with a fraction or an exponent is no integer, also when the fraction is zero: it is
    held as a decimal of at most 18 digits or as a double, whole numbers beyond the long range as a
    longer decimal.
    """
    schema = f"schema_of_variant({value})"
    return (
        f"CASE WHEN {value} IS NULL THEN NULL WHEN startswith({schema}, 'OBJECT') THEN 'object' "
        f"WHEN startswith({schema}, 'ARRAY') THEN 'array' WHEN {schema} = 'STRING' THEN 'string' "
        f"WHEN {schema} = 'BIGINT' OR {schema} RLIKE '^DECIMAL.(19|[23][0-9]),0.$' THEN 'integer' WHEN {schema} = 'BOOLEAN' THEN 'boolean' "
        f"WHEN {schema} = 'VOID' THEN 'null' ELSE 'number' END")


def fields(value: str) -> str:
    """An object as a map of variants; null for any other value."""
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def items(value: str) -> str:
    """An array as an array of variants; null for any other value."""
    return f"try_variant_get({value}, '$', 'array<variant>')"


def is_a(value: str, *kinds: str) -> str:
    """Whether a value is there and of one of these kinds."""
    return f"coalesce({kind(value)} IN ({', '.join(repr(k) for k in kinds)}), false)"


def string(value: str) -> str:
    """The text of a JSON string; null for any other value."""
    return f"if({is_a(value, 'string')}, try_variant_get({value}, '$', 'string'), NULL)"


def number(value: str) -> str:
    """The value of a JSON number as a double; null for any other value."""
    return f"if({is_a(value, 'integer', 'number')}, try_variant_get({value}, '$', 'double'), NULL)"


def shown(value: str) -> str:
    """A value inside a message: the text itself, or its JSON; null if absent."""
    return f"coalesce({string(value)}, if({value} IS NULL, NULL, to_json({value})), 'null')"


def key_tokens(text: str) -> str:
    """All keys of a JSON text at any depth, as they are written, from text without white space between its tokens.

    All strings of the text are taken one after another, so quotes and colons inside of them are
    never seen as keys; a string is a key if a colon follows.
    """
    tokens = f"""regexp_extract_all({text}, '"(?:[^"\\\\\\\\]|\\\\\\\\.)*+":?', 0)"""
    keys = f"transform(filter({tokens}, t -> endswith(t, ':')), t -> substring(t, 1, length(t) - 1))"
    return f"from_json(concat('[', array_join({keys}, ','), ']'), 'array<string>')"
