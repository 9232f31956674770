"""Types of the central tables."""

CANDIDATE_DOCUMENT = """schema_version BIGINT, generated_at_utc STRING, source_report STRING, url_of_data_processing_root STRING,
session STRUCT<date_utc: STRING, session: STRING, camera: STRING>,
totals STRUCT<total: BIGINT, new: BIGINT, known_asteroid: BIGINT, known_variable: BIGINT, known_transient: BIGINT>,
candidates ARRAY<STRUCT<id: STRING, field: STRING, classification: STRING,
 mean: STRUCT<date_utc_iso: STRING, date_utc_dayfraction: STRING, jd_utc: DOUBLE, mag: DOUBLE, ra_hms: STRING, dec_dms: STRING, ra_deg: DOUBLE, dec_deg: DOUBLE, galactic_l_deg: DOUBLE, galactic_b_deg: DOUBLE, constellation: STRING>,
 second_epoch_separation: STRUCT<arcsec: DOUBLE, pix: DOUBLE>, cutouts: MAP<STRING, STRING>,
 discovery_images: ARRAY<STRUCT<label: STRING, date_utc_iso: STRING, date_utc_dayfraction: STRING, jd_utc: DOUBLE, mag: DOUBLE, ra_hms: STRING, dec_dms: STRING, x_pix: DOUBLE, y_pix: DOUBLE, fits_path: STRING, fits_url: STRING>>,
 crossmatches: MAP<STRING, STRUCT<found: BOOLEAN, raw: STRING>>,
 forced_photometry: STRUCT<per_image: ARRAY<STRUCT<wcs_fits: STRING, position_hms: STRING, mag: DOUBLE, mag_err: DOUBLE, flag: STRING>>, reference_weighted_avg: STRUCT<mag: DOUBLE, mag_err: DOUBLE>>,
 external_links: MAP<STRING, STRING>,
 report_stubs: STRUCT<mpc_mean: STRING, mpc_per_image: ARRAY<STRING>, tocp: STRING, aavso: STRING, vsnet: STRING>,
 parse_warnings: ARRAY<STRING>>>,
parse_warnings ARRAY<STRING>, error STRING"""
