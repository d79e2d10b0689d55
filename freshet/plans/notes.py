"""Wording of the notes and verdicts that products carry, by reason code: the one place to change a text."""

NOTES = {
    # gauge match
    "no_id": "no station id given",
    "no_family": "no known kind of measurement given",
    "no_station": "station reference not in the register",
    "family_missing": "register lists other measurements for this station",
    "logged_left_out": "logged series left out",
    "no_datum_left_out": "series without datum left out",
    "means_left_out": "averaged series left out",
    "inactive": "marked inactive, no match",
    "inactive_matched": "marked inactive",
    "out_of_scope": "outside the agreed scope",
    "out_of_scope_matched": "outside the agreed scope, yet matched",
    "import_only": "known to the import list alone",
    "only_one_read": "only this candidate has readings",
    "only_one_recent": "only this candidate has readings of the last {days} days",
    "most_read": "equal candidates; this one has most readings",
    # why several candidates are left
    "periods_differ": "periods differ",
    "qualifiers_differ": "qualifiers differ",
    "both_differ": "qualifiers and periods differ",
    "rest_differs": "alike but for ",
    "all_equal": "alike in everything listed",
    # reports
    "welsh_name": "Welsh word in the name",
    "has_wiski": "WISKI id present",
    "reachable": "in the register",
    "listed": "in the station list alone",
    "known_station": "station known, measure unused",
    "unknown_station": "station unknown to the file",
    "not_in_file": "absent from the mapping file",
    "neither_id": "no mapping row under either id",
    # ids without a match
    "as_written": "present as written",
    "zero_padding": "present with leading zeros",
    "similar_id": "present in a longer form",
    "no_trace": "absent",
    "in_register": "register holds a measure",
    "listed_only": "station list only",
    "not_listed": "no list holds it",
    "ambiguous": "several measures fit",
    "no_parameter": "station lacks this measurement",
    # what to do about it
    "do_listed_only": "No series is published for this station: write to its owner or leave the gap.",
    "do_not_listed": "Unknown id: correct it, or drop the row if the site lies elsewhere.",
    "do_in_register": "See the note of the match for what stopped it.",
    "do_rule": "Add a rule for the other spelling ({reference}).",
    "do_choose": "Pick one of the candidates or keep them all.",
    "do_gap": "This station does not publish the measurement: leave the gap.",
    # thresholds
    "gauge_unknown": "gauge absent from the mapping",
    "gauge_lacks": "gauge lacks this measurement: ",
}
