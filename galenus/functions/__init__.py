"""Column functions and Arrow UDFs: text, licences, identifiers, names, dates, sentences, lots, label sections."""
