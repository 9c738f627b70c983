"""DataFrame-to-DataFrame operators. Fitted ones come as ``fit_*`` (one or few aggregate passes with a
small result) and a narrow apply step."""
