"""Canonical output columns and types of every registered query, kept by hand:
``tests/test_oracle.py`` holds the engine's own schemas against them."""

CONTRACTS: dict[str, list[tuple[str, str]]] = {'ae_performance_monthly': [('activity_month', 'DATE'),
                            ('account_executive', 'VARCHAR'),
                            ('leads_assigned', 'BIGINT'),
                            ('leads_contacted', 'BIGINT'),
                            ('leads_marked_junk', 'BIGINT'),
                            ('avg_lead_score', 'DECIMAL(38,6)'),
                            ('policies_bound', 'BIGINT'),
                            ('new_policies_bound', 'BIGINT'),
                            ('renewals_bound', 'BIGINT'),
                            ('unique_businesses_bound', 'BIGINT'),
                            ('total_premium', 'DECIMAL(38,4)'),
                            ('total_estimated_commission', 'DECIMAL(38,8)'),
                            ('avg_premium_per_policy', 'DECIMAL(38,6)'),
                            ('distinct_policy_types', 'BIGINT'),
                            ('contact_rate_pct', 'DECIMAL(38,2)'),
                            ('contact_to_bind_rate_pct', 'DECIMAL(38,2)'),
                            ('overall_close_rate_pct', 'DECIMAL(38,2)')],
 'agg01_group_by': [('l_returnflag', 'VARCHAR'),
                    ('l_linestatus', 'VARCHAR'),
                    ('sum_qty', 'DECIMAL(38,4)'),
                    ('sum_base_price', 'DECIMAL(38,4)'),
                    ('count_order', 'BIGINT'),
                    ('count_shipped', 'BIGINT')],
 'agg03_count_distinct': [('user_id', 'BIGINT'), ('n_event_types', 'BIGINT'), ('n_active_days', 'BIGINT')],
 'agg03_distinct_bitmaps': [('month_start', 'DATE'),
                            ('n_customers', 'BIGINT'),
                            ('n_finished', 'BIGINT'),
                            ('n_urgent', 'BIGINT')],
 'agg04_sum_flags': [('l_partkey', 'BIGINT'), ('qty', 'DECIMAL(38,4)'), ('n_returned', 'BIGINT')],
 'agg05_avg': [('l_suppkey', 'BIGINT'), ('avg_qty', 'DECIMAL(38,6)'), ('avg_price', 'DECIMAL(38,6)')],
 'agg06_min_max': [('user_id', 'BIGINT'),
                   ('first_at', 'TIMESTAMP'),
                   ('last_at', 'TIMESTAMP'),
                   ('min_value', 'DECIMAL(38,4)'),
                   ('max_value', 'DECIMAL(38,4)')],
 'agg07_filter': [('user_id', 'BIGINT'),
                  ('clicks', 'BIGINT'),
                  ('purchase_value', 'DECIMAL(38,4)'),
                  ('first_error_at', 'TIMESTAMP')],
 'agg08_case_agg': [('o_orderstatus', 'VARCHAR'),
                    ('high_priority', 'BIGINT'),
                    ('low_priority_total', 'DECIMAL(38,4)')],
 'agg09_bool_or': [('user_id', 'BIGINT'), ('had_error', 'BOOLEAN'), ('all_above_one', 'BOOLEAN')],
 'agg10_latest_value': [('user_id', 'BIGINT'), ('kind', 'VARCHAR'), ('latest_at', 'TIMESTAMP')],
 'agg11_dependent_attr': [('o_custkey', 'BIGINT'), ('n_orders', 'BIGINT'), ('nation', 'VARCHAR')],
 'agg12_preagg_join': [('c_custkey', 'BIGINT'),
                       ('n_orders', 'BIGINT'),
                       ('n_lines', 'BIGINT'),
                       ('n_events', 'BIGINT')],
 'business_funnel_daily': [('activity_date', 'DATE'),
                           ('license_name', 'VARCHAR'),
                           ('businesses_with_app', 'BIGINT'),
                           ('applications_started', 'BIGINT'),
                           ('businesses_quoted', 'BIGINT'),
                           ('quotes_generated', 'BIGINT'),
                           ('businesses_bound', 'BIGINT'),
                           ('policies_bound', 'BIGINT'),
                           ('total_premium_bound', 'DECIMAL(38,4)'),
                           ('total_estimated_commission', 'DECIMAL(38,8)'),
                           ('quote_to_bind_rate_pct', 'DECIMAL(38,2)'),
                           ('businesses_created', 'BIGINT')],
 'dim_date': [('date_day', 'DATE'),
              ('week_start', 'DATE'),
              ('month_start', 'DATE'),
              ('quarter_start', 'DATE'),
              ('year_start', 'DATE'),
              ('year', 'BIGINT'),
              ('quarter', 'BIGINT'),
              ('month', 'BIGINT'),
              ('year_month', 'VARCHAR'),
              ('day_of_month', 'BIGINT'),
              ('day_of_week', 'BIGINT'),
              ('day_name', 'VARCHAR'),
              ('is_weekend', 'BOOLEAN'),
              ('is_month_end', 'BOOLEAN'),
              ('is_past_or_today', 'BOOLEAN'),
              ('is_today', 'BOOLEAN')],
 'dq01_not_null': [('failures', 'BIGINT')],
 'dq02_unique': [('l_orderkey', 'BIGINT'), ('n_records', 'BIGINT')],
 'dq03_accepted_values': [('o_orderstatus', 'VARCHAR'), ('failures', 'BIGINT')],
 'dq04_unique_combo': [('l_orderkey', 'BIGINT'), ('l_linenumber', 'BIGINT'), ('n_records', 'BIGINT')],
 'dq_model_checks': [('model', 'VARCHAR'),
                     ('test', 'VARCHAR'),
                     ('severity', 'VARCHAR'),
                     ('failures', 'BIGINT'),
                     ('status', 'VARCHAR')],
 'flt05_distinct_from': [('o_orderstatus', 'VARCHAR'), ('n_orders', 'BIGINT')],
 'flt06_like_ilike': [('p_partkey', 'BIGINT'), ('bucket', 'VARCHAR')],
 'flt08_not_and_time': [('l_returnflag', 'VARCHAR'),
                        ('l_linestatus', 'VARCHAR'),
                        ('n_lines', 'BIGINT'),
                        ('sum_qty', 'DECIMAL(38,4)')],
 'flt_eq_in_null': [('l_orderkey', 'BIGINT'),
                    ('l_linenumber', 'BIGINT'),
                    ('l_partkey', 'BIGINT'),
                    ('l_quantity', 'DOUBLE'),
                    ('l_returnflag', 'VARCHAR'),
                    ('l_linestatus', 'VARCHAR'),
                    ('l_shipdate', 'TIMESTAMP')],
 'int_ae_sales_policy': [('policy_id', 'BIGINT'),
                         ('business_id', 'BIGINT'),
                         ('policy_created_at', 'TIMESTAMP'),
                         ('policy_created_date', 'DATE'),
                         ('sale_type', 'VARCHAR'),
                         ('bor_renewal', 'BOOLEAN'),
                         ('premium', 'DECIMAL(38,4)'),
                         ('current_status', 'VARCHAR'),
                         ('snapshot_at', 'TIMESTAMP'),
                         ('status_at_snapshot', 'VARCHAR'),
                         ('is_eligible_sale_type', 'BOOLEAN'),
                         ('has_premium', 'BOOLEAN'),
                         ('is_test_carrier', 'BOOLEAN'),
                         ('is_test_business_flag', 'BOOLEAN'),
                         ('is_test_name_ae_rule', 'BOOLEAN'),
                         ('has_required_joins', 'BOOLEAN'),
                         ('is_ae_sales_policy', 'BOOLEAN')],
 'int_ae_sales_snapshot_status': [('policy_id', 'BIGINT'),
                                  ('last_new_status_before', 'VARCHAR'),
                                  ('first_old_status_after', 'VARCHAR')],
 'int_business': [('business_id', 'BIGINT'),
                  ('user_id', 'BIGINT'),
                  ('close_lead_id', 'VARCHAR'),
                  ('business_name', 'VARCHAR'),
                  ('owner_name', 'VARCHAR'),
                  ('owner_email', 'VARCHAR'),
                  ('legal_entity_type', 'VARCHAR'),
                  ('company_type', 'VARCHAR'),
                  ('total_annual_revenue', 'DOUBLE'),
                  ('total_annual_payroll', 'DOUBLE'),
                  ('total_number_of_employees', 'BIGINT'),
                  ('years_in_business', 'BIGINT'),
                  ('close_status', 'VARCHAR'),
                  ('is_high_risk', 'BOOLEAN'),
                  ('is_test_business', 'BOOLEAN'),
                  ('business_created_at', 'TIMESTAMP'),
                  ('business_created_date', 'DATE'),
                  ('business_created_week', 'DATE'),
                  ('business_created_month', 'DATE'),
                  ('business_age_days', 'BIGINT'),
                  ('license_name', 'VARCHAR'),
                  ('partner_name', 'VARCHAR'),
                  ('partner_profile_type', 'VARCHAR'),
                  ('transfer_type', 'VARCHAR'),
                  ('warm_transfer_campaign', 'VARCHAR'),
                  ('campaign_type', 'VARCHAR'),
                  ('warm_transfer_campaign_name', 'VARCHAR'),
                  ('claimed_status', 'VARCHAR'),
                  ('warm_transfer_status', 'VARCHAR'),
                  ('first_warm_transfer_at', 'TIMESTAMP'),
                  ('warm_transfer_bid_price', 'DECIMAL(38,4)'),
                  ('credited_account_executive', 'VARCHAR'),
                  ('credited_ae_team', 'VARCHAR'),
                  ('credited_ae_employee_type', 'VARCHAR'),
                  ('account_executive', 'VARCHAR'),
                  ('account_manager', 'VARCHAR'),
                  ('sold_by', 'VARCHAR'),
                  ('lead_id', 'BIGINT'),
                  ('lead_account_executive', 'VARCHAR'),
                  ('workflow_type', 'VARCHAR'),
                  ('made_contact', 'BOOLEAN'),
                  ('is_junk', 'BOOLEAN'),
                  ('lead_score', 'BIGINT'),
                  ('lead_created_at', 'TIMESTAMP'),
                  ('lead_expiry_time', 'TIMESTAMP'),
                  ('classification_name', 'VARCHAR'),
                  ('naics_code', 'VARCHAR'),
                  ('industry', 'VARCHAR'),
                  ('sub_industry', 'VARCHAR'),
                  ('naics_sub_industry', 'VARCHAR'),
                  ('first_attempted_to_contact_at', 'TIMESTAMP'),
                  ('first_made_contact_at', 'TIMESTAMP'),
                  ('first_junk_at', 'TIMESTAMP'),
                  ('first_customer_status_at', 'TIMESTAMP'),
                  ('first_application_started_at', 'TIMESTAMP'),
                  ('first_application_submitted_at', 'TIMESTAMP'),
                  ('first_viewed_application_submitted_at', 'TIMESTAMP'),
                  ('first_admin_rater_application_at', 'TIMESTAMP'),
                  ('first_manual_application_at', 'TIMESTAMP'),
                  ('first_quoting_status_at', 'TIMESTAMP'),
                  ('first_sit_status_at', 'TIMESTAMP'),
                  ('first_quoted_status_at', 'TIMESTAMP'),
                  ('first_quote_presented_at', 'TIMESTAMP'),
                  ('first_won_status_at', 'TIMESTAMP'),
                  ('first_lost_status_at', 'TIMESTAMP'),
                  ('first_quote_created_at', 'TIMESTAMP'),
                  ('first_chubb_quote_created_at', 'TIMESTAMP'),
                  ('first_gaig_quote_created_at', 'TIMESTAMP'),
                  ('first_policy_created_at', 'TIMESTAMP'),
                  ('first_nb_policy_created_at', 'TIMESTAMP'),
                  ('first_nb_chubb_policy_created_at', 'TIMESTAMP'),
                  ('first_nb_gaig_policy_created_at', 'TIMESTAMP'),
                  ('first_nb_cancellation_booked_at', 'TIMESTAMP'),
                  ('days_to_attempted_to_contact', 'BIGINT'),
                  ('days_to_made_contact', 'BIGINT'),
                  ('days_to_junk', 'BIGINT'),
                  ('days_to_application_submitted', 'BIGINT'),
                  ('days_to_quote_presented', 'BIGINT'),
                  ('days_to_first_quote', 'BIGINT'),
                  ('days_to_first_chubb_quote', 'BIGINT'),
                  ('days_to_first_gaig_quote', 'BIGINT'),
                  ('days_to_first_policy', 'BIGINT'),
                  ('days_to_first_nb_policy', 'BIGINT'),
                  ('days_to_first_nb_chubb_policy', 'BIGINT'),
                  ('days_to_first_nb_gaig_policy', 'BIGINT'),
                  ('submitted_application_count', 'BIGINT'),
                  ('quote_count', 'BIGINT'),
                  ('total_quoted_premium', 'DECIMAL(38,4)'),
                  ('chubb_quoted_premium', 'DECIMAL(38,4)'),
                  ('gaig_quoted_premium', 'DECIMAL(38,4)'),
                  ('policy_count', 'BIGINT'),
                  ('active_policy_count', 'BIGINT'),
                  ('nb_policy_count', 'BIGINT'),
                  ('total_premium', 'DECIMAL(38,4)'),
                  ('active_premium', 'DECIMAL(38,4)'),
                  ('nb_premium', 'DECIMAL(38,4)'),
                  ('d30_nb_premium', 'DECIMAL(38,4)'),
                  ('nb_chubb_premium', 'DECIMAL(38,4)'),
                  ('d30_nb_chubb_premium', 'DECIMAL(38,4)'),
                  ('nb_gaig_premium', 'DECIMAL(38,4)'),
                  ('d30_nb_gaig_premium', 'DECIMAL(38,4)'),
                  ('d7_nb_gross_revenue', 'DECIMAL(38,4)'),
                  ('d14_nb_gross_revenue', 'DECIMAL(38,4)'),
                  ('d30_nb_gross_revenue', 'DECIMAL(38,4)'),
                  ('nb_gross_revenue', 'DECIMAL(38,4)'),
                  ('d30_nb_chubb_gross_revenue', 'DECIMAL(38,4)'),
                  ('d30_nb_gaig_gross_revenue', 'DECIMAL(38,4)'),
                  ('d30_nb_core_revenue', 'DECIMAL(38,4)'),
                  ('nb_core_revenue', 'DECIMAL(38,4)'),
                  ('nb_cancellation_amount', 'DECIMAL(38,4)'),
                  ('total_core_revenue', 'DECIMAL(38,4)'),
                  ('is_mature_d7', 'BIGINT'),
                  ('is_mature_d14', 'BIGINT'),
                  ('is_mature_d30', 'BIGINT'),
                  ('is_mature_d60', 'BIGINT'),
                  ('is_mature_d90', 'BIGINT'),
                  ('d7_attempted_to_contact', 'BIGINT'),
                  ('d7_made_contact', 'BIGINT'),
                  ('d7_junk', 'BIGINT'),
                  ('quoted', 'BIGINT'),
                  ('d7_quoted', 'BIGINT'),
                  ('d30_quoted', 'BIGINT'),
                  ('days_to_d30_quote', 'BIGINT'),
                  ('d7_quote_presented', 'BIGINT'),
                  ('converted', 'BIGINT'),
                  ('d1_converted', 'BIGINT'),
                  ('d7_converted', 'BIGINT'),
                  ('d14_converted', 'BIGINT'),
                  ('d30_converted', 'BIGINT'),
                  ('d60_converted', 'BIGINT'),
                  ('d90_converted', 'BIGINT'),
                  ('d7_chubb_quoted', 'BIGINT'),
                  ('d7_chubb_converted', 'BIGINT'),
                  ('d30_chubb_converted', 'BIGINT'),
                  ('d7_gaig_quoted', 'BIGINT'),
                  ('d7_gaig_converted', 'BIGINT'),
                  ('d30_gaig_converted', 'BIGINT')],
 'int_business_application_milestones': [('business_id', 'BIGINT'),
                                         ('first_application_started_at', 'TIMESTAMP'),
                                         ('submitted_application_count', 'BIGINT'),
                                         ('first_application_submitted_at', 'TIMESTAMP'),
                                         ('first_viewed_application_submitted_at', 'TIMESTAMP'),
                                         ('first_admin_rater_application_at', 'TIMESTAMP'),
                                         ('first_manual_application_at', 'TIMESTAMP')],
 'int_business_close_status': [('business_id', 'BIGINT'),
                               ('first_attempted_to_contact_at', 'TIMESTAMP'),
                               ('first_made_contact_at', 'TIMESTAMP'),
                               ('first_junk_at', 'TIMESTAMP'),
                               ('first_customer_status_at', 'TIMESTAMP')],
 'int_business_joined': [('business_id', 'BIGINT'),
                         ('user_id', 'BIGINT'),
                         ('close_lead_id', 'VARCHAR'),
                         ('business_name', 'VARCHAR'),
                         ('owner_name', 'VARCHAR'),
                         ('owner_email', 'VARCHAR'),
                         ('legal_entity_type', 'VARCHAR'),
                         ('company_type', 'VARCHAR'),
                         ('total_annual_revenue', 'DOUBLE'),
                         ('total_annual_payroll', 'DOUBLE'),
                         ('total_number_of_employees', 'BIGINT'),
                         ('years_in_business', 'BIGINT'),
                         ('close_status', 'VARCHAR'),
                         ('is_high_risk', 'BOOLEAN'),
                         ('is_test_business', 'BOOLEAN'),
                         ('business_created_at', 'TIMESTAMP'),
                         ('business_created_date', 'DATE'),
                         ('business_created_week', 'DATE'),
                         ('business_created_month', 'DATE'),
                         ('business_age_days', 'BIGINT'),
                         ('license_name', 'VARCHAR'),
                         ('partner_name', 'VARCHAR'),
                         ('partner_profile_type', 'VARCHAR'),
                         ('transfer_type', 'VARCHAR'),
                         ('warm_transfer_campaign', 'VARCHAR'),
                         ('campaign_type', 'VARCHAR'),
                         ('warm_transfer_campaign_name', 'VARCHAR'),
                         ('claimed_status', 'VARCHAR'),
                         ('warm_transfer_status', 'VARCHAR'),
                         ('first_warm_transfer_at', 'TIMESTAMP'),
                         ('warm_transfer_bid_price', 'DECIMAL(38,4)'),
                         ('credited_account_executive', 'VARCHAR'),
                         ('credited_ae_team', 'VARCHAR'),
                         ('credited_ae_employee_type', 'VARCHAR'),
                         ('account_executive', 'VARCHAR'),
                         ('account_manager', 'VARCHAR'),
                         ('sold_by', 'VARCHAR'),
                         ('lead_id', 'BIGINT'),
                         ('lead_account_executive', 'VARCHAR'),
                         ('workflow_type', 'VARCHAR'),
                         ('made_contact', 'BOOLEAN'),
                         ('is_junk', 'BOOLEAN'),
                         ('lead_score', 'BIGINT'),
                         ('lead_created_at', 'TIMESTAMP'),
                         ('lead_expiry_time', 'TIMESTAMP'),
                         ('classification_name', 'VARCHAR'),
                         ('naics_code', 'VARCHAR'),
                         ('industry', 'VARCHAR'),
                         ('sub_industry', 'VARCHAR'),
                         ('naics_sub_industry', 'VARCHAR'),
                         ('first_attempted_to_contact_at', 'TIMESTAMP'),
                         ('first_made_contact_at', 'TIMESTAMP'),
                         ('first_junk_at', 'TIMESTAMP'),
                         ('first_customer_status_at', 'TIMESTAMP'),
                         ('first_application_started_at', 'TIMESTAMP'),
                         ('first_application_submitted_at', 'TIMESTAMP'),
                         ('first_viewed_application_submitted_at', 'TIMESTAMP'),
                         ('first_admin_rater_application_at', 'TIMESTAMP'),
                         ('first_manual_application_at', 'TIMESTAMP'),
                         ('first_quoting_status_at', 'TIMESTAMP'),
                         ('first_sit_status_at', 'TIMESTAMP'),
                         ('first_quoted_status_at', 'TIMESTAMP'),
                         ('first_quote_presented_at', 'TIMESTAMP'),
                         ('first_won_status_at', 'TIMESTAMP'),
                         ('first_lost_status_at', 'TIMESTAMP'),
                         ('first_quote_created_at', 'TIMESTAMP'),
                         ('first_chubb_quote_created_at', 'TIMESTAMP'),
                         ('first_gaig_quote_created_at', 'TIMESTAMP'),
                         ('first_policy_created_at', 'TIMESTAMP'),
                         ('first_nb_policy_created_at', 'TIMESTAMP'),
                         ('first_nb_chubb_policy_created_at', 'TIMESTAMP'),
                         ('first_nb_gaig_policy_created_at', 'TIMESTAMP'),
                         ('first_nb_cancellation_booked_at', 'TIMESTAMP'),
                         ('days_to_attempted_to_contact', 'BIGINT'),
                         ('days_to_made_contact', 'BIGINT'),
                         ('days_to_junk', 'BIGINT'),
                         ('days_to_application_submitted', 'BIGINT'),
                         ('days_to_quote_presented', 'BIGINT'),
                         ('days_to_first_quote', 'BIGINT'),
                         ('days_to_first_chubb_quote', 'BIGINT'),
                         ('days_to_first_gaig_quote', 'BIGINT'),
                         ('days_to_first_policy', 'BIGINT'),
                         ('days_to_first_nb_policy', 'BIGINT'),
                         ('days_to_first_nb_chubb_policy', 'BIGINT'),
                         ('days_to_first_nb_gaig_policy', 'BIGINT'),
                         ('submitted_application_count', 'BIGINT'),
                         ('quote_count', 'BIGINT'),
                         ('total_quoted_premium', 'DECIMAL(38,4)'),
                         ('chubb_quoted_premium', 'DECIMAL(38,4)'),
                         ('gaig_quoted_premium', 'DECIMAL(38,4)'),
                         ('policy_count', 'BIGINT'),
                         ('active_policy_count', 'BIGINT'),
                         ('nb_policy_count', 'BIGINT'),
                         ('total_premium', 'DECIMAL(38,4)'),
                         ('active_premium', 'DECIMAL(38,4)'),
                         ('nb_premium', 'DECIMAL(38,4)'),
                         ('d30_nb_premium', 'DECIMAL(38,4)'),
                         ('nb_chubb_premium', 'DECIMAL(38,4)'),
                         ('d30_nb_chubb_premium', 'DECIMAL(38,4)'),
                         ('nb_gaig_premium', 'DECIMAL(38,4)'),
                         ('d30_nb_gaig_premium', 'DECIMAL(38,4)'),
                         ('d7_nb_gross_revenue', 'DECIMAL(38,4)'),
                         ('d14_nb_gross_revenue', 'DECIMAL(38,4)'),
                         ('d30_nb_gross_revenue', 'DECIMAL(38,4)'),
                         ('nb_gross_revenue', 'DECIMAL(38,4)'),
                         ('d30_nb_chubb_gross_revenue', 'DECIMAL(38,4)'),
                         ('d30_nb_gaig_gross_revenue', 'DECIMAL(38,4)'),
                         ('d30_nb_core_revenue', 'DECIMAL(38,4)'),
                         ('nb_core_revenue', 'DECIMAL(38,4)'),
                         ('nb_cancellation_amount', 'DECIMAL(38,4)'),
                         ('total_core_revenue', 'DECIMAL(38,4)')],
 'int_business_lead': [('business_id', 'BIGINT'),
                       ('lead_id', 'BIGINT'),
                       ('lead_account_executive', 'VARCHAR'),
                       ('workflow_type_assigned', 'VARCHAR'),
                       ('made_contact', 'BOOLEAN'),
                       ('is_junk', 'BOOLEAN'),
                       ('lead_score', 'BIGINT'),
                       ('lead_created_at', 'TIMESTAMP'),
                       ('lead_expiry_time', 'TIMESTAMP')],
 'int_business_opportunity_milestones': [('business_id', 'BIGINT'),
                                         ('first_quoting_status_at', 'TIMESTAMP'),
                                         ('first_sit_status_at', 'TIMESTAMP'),
                                         ('first_quoted_status_at', 'TIMESTAMP'),
                                         ('first_quote_presented_at', 'TIMESTAMP'),
                                         ('first_won_status_at', 'TIMESTAMP'),
                                         ('first_lost_status_at', 'TIMESTAMP')],
 'int_business_policy_rollup': [('business_id', 'BIGINT'),
                                ('first_policy_created_at', 'TIMESTAMP'),
                                ('policy_count', 'BIGINT'),
                                ('total_premium', 'DECIMAL(38,4)'),
                                ('active_policy_count', 'BIGINT'),
                                ('active_premium', 'DECIMAL(38,4)'),
                                ('first_nb_policy_created_at', 'TIMESTAMP'),
                                ('nb_policy_count', 'BIGINT'),
                                ('nb_premium', 'DECIMAL(38,4)'),
                                ('d30_nb_premium', 'DECIMAL(38,4)'),
                                ('first_nb_chubb_policy_created_at', 'TIMESTAMP'),
                                ('nb_chubb_premium', 'DECIMAL(38,4)'),
                                ('d30_nb_chubb_premium', 'DECIMAL(38,4)'),
                                ('first_nb_gaig_policy_created_at', 'TIMESTAMP'),
                                ('nb_gaig_premium', 'DECIMAL(38,4)'),
                                ('d30_nb_gaig_premium', 'DECIMAL(38,4)')],
 'int_business_quote_rollup': [('business_id', 'BIGINT'),
                               ('first_quote_created_at', 'TIMESTAMP'),
                               ('quote_count', 'BIGINT'),
                               ('total_quoted_premium', 'DECIMAL(38,4)'),
                               ('first_chubb_quote_created_at', 'TIMESTAMP'),
                               ('chubb_quoted_premium', 'DECIMAL(38,4)'),
                               ('first_gaig_quote_created_at', 'TIMESTAMP'),
                               ('gaig_quoted_premium', 'DECIMAL(38,4)')],
 'int_business_revenue_rollup': [('business_id', 'BIGINT'),
                                 ('d7_nb_gross_revenue', 'DECIMAL(38,4)'),
                                 ('d14_nb_gross_revenue', 'DECIMAL(38,4)'),
                                 ('d30_nb_gross_revenue', 'DECIMAL(38,4)'),
                                 ('nb_gross_revenue', 'DECIMAL(38,4)'),
                                 ('d30_nb_chubb_gross_revenue', 'DECIMAL(38,4)'),
                                 ('d30_nb_gaig_gross_revenue', 'DECIMAL(38,4)'),
                                 ('d30_nb_core_revenue', 'DECIMAL(38,4)'),
                                 ('nb_core_revenue', 'DECIMAL(38,4)'),
                                 ('nb_cancellation_amount', 'DECIMAL(38,4)'),
                                 ('first_nb_cancellation_booked_at', 'TIMESTAMP'),
                                 ('total_core_revenue', 'DECIMAL(38,4)')],
 'int_business_warm_transfer': [('business_id', 'BIGINT'),
                                ('warm_transfer_count', 'BIGINT'),
                                ('warm_transfer_bid_price', 'DECIMAL(38,4)'),
                                ('first_warm_transfer_at', 'TIMESTAMP'),
                                ('warm_transfer_claimed_status', 'VARCHAR'),
                                ('warm_transfer_status', 'VARCHAR'),
                                ('warm_transfer_campaign_status_id', 'BIGINT')],
 'int_nb_revenue_transaction': [('policy_transaction_id', 'BIGINT'),
                                ('policy_id', 'BIGINT'),
                                ('business_id', 'BIGINT'),
                                ('booked_at', 'TIMESTAMP'),
                                ('booked_date', 'DATE'),
                                ('transaction_type', 'VARCHAR'),
                                ('revenue_bucket', 'VARCHAR'),
                                ('direction', 'VARCHAR'),
                                ('is_cancellation_driven', 'BOOLEAN'),
                                ('signed_amount', 'DECIMAL(38,4)'),
                                ('policy_created_at', 'TIMESTAMP'),
                                ('business_created_at', 'TIMESTAMP'),
                                ('days_policy_to_booking', 'BIGINT')],
 'int_policy_revenue': [('policy_id', 'BIGINT'),
                        ('business_id', 'BIGINT'),
                        ('carrier_id', 'BIGINT'),
                        ('quote_id', 'BIGINT'),
                        ('close_opportunity_id', 'VARCHAR'),
                        ('renewed_from_policy_id', 'BIGINT'),
                        ('policy_type', 'VARCHAR'),
                        ('license_name', 'VARCHAR'),
                        ('policy_license_name', 'VARCHAR'),
                        ('billing_type', 'VARCHAR'),
                        ('sale_type', 'VARCHAR'),
                        ('sales_channel', 'VARCHAR'),
                        ('underwriting_carrier', 'VARCHAR'),
                        ('account_executive', 'VARCHAR'),
                        ('assigned_agent', 'VARCHAR'),
                        ('is_renewal', 'BOOLEAN'),
                        ('renewal_count', 'BIGINT'),
                        ('bor_renewal', 'BOOLEAN'),
                        ('is_auto_bind', 'BOOLEAN'),
                        ('is_paygo', 'BOOLEAN'),
                        ('premium', 'DECIMAL(38,4)'),
                        ('commissionable_premium', 'DECIMAL(38,4)'),
                        ('commission_rate', 'DECIMAL(38,6)'),
                        ('estimated_commission', 'DECIMAL(38,8)'),
                        ('mmr_fee', 'DECIMAL(38,4)'),
                        ('effective_date', 'DATE'),
                        ('expiry_date', 'DATE'),
                        ('bound_at', 'TIMESTAMP'),
                        ('bound_date', 'DATE'),
                        ('bound_week', 'DATE'),
                        ('bound_month', 'DATE'),
                        ('bound_quarter', 'DATE'),
                        ('bound_year', 'BIGINT'),
                        ('effective_month', 'DATE')],
 'int_ringba_call': [('ringba_call_id', 'BIGINT'),
                     ('inbound_call_id', 'VARCHAR'),
                     ('campaign_status_id', 'BIGINT'),
                     ('caller_number', 'VARCHAR'),
                     ('called_at', 'TIMESTAMP'),
                     ('call_date', 'DATE'),
                     ('call_week', 'DATE'),
                     ('call_month', 'DATE'),
                     ('partner_name', 'VARCHAR'),
                     ('campaign_name', 'VARCHAR'),
                     ('is_high_revenue_campaign', 'BOOLEAN'),
                     ('event_count', 'BIGINT'),
                     ('ae_count_dialed', 'BIGINT'),
                     ('is_routed', 'BOOLEAN'),
                     ('is_answered', 'BOOLEAN'),
                     ('is_missed', 'BOOLEAN'),
                     ('is_unrouted', 'BOOLEAN'),
                     ('is_duplicate', 'BOOLEAN'),
                     ('is_no_target_found', 'BOOLEAN'),
                     ('no_answer_events', 'BIGINT'),
                     ('answered_by', 'VARCHAR'),
                     ('first_dialed_at', 'TIMESTAMP'),
                     ('answered_at', 'TIMESTAMP'),
                     ('seconds_to_answer', 'BIGINT'),
                     ('call_length_seconds', 'BIGINT'),
                     ('has_converted', 'BOOLEAN')],
 'int_ringba_call_ae': [('ringba_call_id', 'BIGINT'),
                        ('account_executive', 'VARCHAR'),
                        ('ae_team', 'VARCHAR'),
                        ('ae_employee_type', 'VARCHAR'),
                        ('call_date', 'DATE'),
                        ('call_week', 'DATE'),
                        ('call_month', 'DATE'),
                        ('partner_name', 'VARCHAR'),
                        ('campaign_name', 'VARCHAR'),
                        ('caller_number', 'VARCHAR'),
                        ('is_duplicate', 'BOOLEAN'),
                        ('call_was_answered', 'BOOLEAN'),
                        ('was_dialed', 'BOOLEAN'),
                        ('was_answered', 'BOOLEAN'),
                        ('was_missed', 'BOOLEAN'),
                        ('no_answer_events', 'BIGINT'),
                        ('busy_events', 'BIGINT'),
                        ('first_dialed_at', 'TIMESTAMP'),
                        ('answered_at', 'TIMESTAMP'),
                        ('answered_call_length_seconds', 'BIGINT')],
 'int_ringba_call_events': [('ringba_call_id', 'BIGINT'),
                            ('event_count', 'BIGINT'),
                            ('ae_count_dialed', 'BIGINT'),
                            ('is_routed', 'BOOLEAN'),
                            ('is_answered', 'BOOLEAN'),
                            ('is_duplicate', 'BOOLEAN'),
                            ('is_no_target_found', 'BOOLEAN'),
                            ('no_answer_events', 'BIGINT'),
                            ('first_dialed_at', 'TIMESTAMP'),
                            ('answered_at', 'TIMESTAMP'),
                            ('answered_by', 'VARCHAR')],
 'int_warm_transfer': [('warm_transfer_id', 'BIGINT'),
                       ('business_id', 'BIGINT'),
                       ('campaign_status_id', 'BIGINT'),
                       ('created_at', 'TIMESTAMP'),
                       ('created_date', 'DATE'),
                       ('created_week', 'DATE'),
                       ('created_month', 'DATE'),
                       ('ping_age_days', 'BIGINT'),
                       ('partner_name', 'VARCHAR'),
                       ('partner_resolved_from', 'VARCHAR'),
                       ('campaign_name', 'VARCHAR'),
                       ('is_high_revenue_campaign', 'BOOLEAN'),
                       ('status', 'VARCHAR'),
                       ('is_accepted', 'BOOLEAN'),
                       ('is_rejected', 'BOOLEAN'),
                       ('is_error', 'BOOLEAN'),
                       ('is_received', 'BOOLEAN'),
                       ('claimed_status', 'VARCHAR'),
                       ('rejection_reason', 'VARCHAR'),
                       ('rejection_reason_category', 'VARCHAR'),
                       ('bid_price', 'DECIMAL(38,4)'),
                       ('accepted_bid_price', 'DECIMAL(38,4)'),
                       ('license_name', 'VARCHAR'),
                       ('transfer_type', 'VARCHAR'),
                       ('credited_account_executive', 'VARCHAR'),
                       ('credited_ae_team', 'VARCHAR'),
                       ('workflow_type', 'VARCHAR'),
                       ('is_test_business', 'BOOLEAN'),
                       ('quoted', 'BIGINT'),
                       ('d7_quoted', 'BIGINT'),
                       ('converted', 'BIGINT'),
                       ('d7_converted', 'BIGINT'),
                       ('d30_converted', 'BIGINT'),
                       ('nb_policy_count', 'BIGINT'),
                       ('nb_premium', 'DECIMAL(38,4)'),
                       ('d30_nb_premium', 'DECIMAL(38,4)'),
                       ('d30_nb_gross_revenue', 'DECIMAL(38,4)'),
                       ('nb_gross_revenue', 'DECIMAL(38,4)')],
 'jn01_inner': [('n_name', 'VARCHAR'), ('n_orders', 'BIGINT'), ('revenue', 'DECIMAL(38,4)')],
 'jn02_spine': [('date_day', 'DATE'), ('week_start', 'DATE'), ('n_orders', 'BIGINT')],
 'jn03_left': [('c_custkey', 'BIGINT'),
               ('c_name', 'VARCHAR'),
               ('n_orders', 'BIGINT'),
               ('order_total', 'DECIMAL(38,4)')],
 'jn04_full_outer': [('month', 'DATE'), ('status', 'VARCHAR'), ('n_orders', 'BIGINT'), ('n_lines', 'BIGINT')],
 'jn05_full_outer_chain': [('day', 'DATE'),
                           ('n_orders', 'BIGINT'),
                           ('n_lines', 'BIGINT'),
                           ('n_events', 'BIGINT')],
 'jn06_range_residual': [('o_orderkey', 'BIGINT'),
                         ('o_custkey', 'BIGINT'),
                         ('o_orderdate', 'TIMESTAMP'),
                         ('first_order_at', 'TIMESTAMP')],
 'jn07_asof_backward': [('user_id', 'BIGINT'), ('last_view_event_id', 'BIGINT')],
 'jn07_asof_forward': [('user_id', 'BIGINT'), ('first_error_event_id', 'BIGINT')],
 'jn07_asof_scan': [('event_id', 'BIGINT'),
                    ('user_id', 'BIGINT'),
                    ('last_view_event_id', 'BIGINT'),
                    ('first_error_event_id', 'BIGINT')],
 'jn08_existence_flag': [('c_custkey', 'BIGINT'), ('has_urgent_order', 'BOOLEAN')],
 'jn_left_null_keys': [('event_id', 'BIGINT'), ('k', 'BIGINT'), ('c_name', 'VARCHAR')],
 'nb_sales_daily': [('activity_date', 'DATE'),
                    ('same_month_sale', 'BOOLEAN'),
                    ('license_name', 'VARCHAR'),
                    ('account_executive', 'VARCHAR'),
                    ('week_start', 'DATE'),
                    ('month_start', 'DATE'),
                    ('quarter_start', 'DATE'),
                    ('year', 'BIGINT'),
                    ('is_weekend', 'BOOLEAN'),
                    ('transfer_type', 'VARCHAR'),
                    ('partner_name', 'VARCHAR'),
                    ('ae_team', 'VARCHAR'),
                    ('nb_net_revenue', 'DECIMAL(38,4)'),
                    ('commission', 'DECIMAL(38,4)'),
                    ('tech_fee', 'DECIMAL(38,4)'),
                    ('endorsement', 'DECIMAL(38,4)'),
                    ('cancellation', 'DECIMAL(38,4)'),
                    ('business_count', 'BIGINT'),
                    ('ae_sales_policies', 'BIGINT'),
                    ('ae_sales_premium', 'DECIMAL(38,4)')],
 'policy_revenue_summary': [('bound_month', 'DATE'),
                            ('bound_quarter', 'DATE'),
                            ('bound_year', 'BIGINT'),
                            ('policy_type', 'VARCHAR'),
                            ('license_name', 'VARCHAR'),
                            ('underwriting_carrier', 'VARCHAR'),
                            ('billing_type', 'VARCHAR'),
                            ('sale_type', 'VARCHAR'),
                            ('sales_channel', 'VARCHAR'),
                            ('is_renewal', 'BOOLEAN'),
                            ('is_paygo', 'BOOLEAN'),
                            ('policies_bound', 'BIGINT'),
                            ('unique_businesses', 'BIGINT'),
                            ('gross_written_premium', 'DECIMAL(38,4)'),
                            ('total_commissionable_premium', 'DECIMAL(38,4)'),
                            ('total_estimated_commission', 'DECIMAL(38,8)'),
                            ('total_mmr_fees', 'DECIMAL(38,4)'),
                            ('avg_premium', 'DECIMAL(38,6)'),
                            ('avg_commission_rate', 'DECIMAL(38,6)'),
                            ('new_business_policies', 'BIGINT'),
                            ('renewal_policies', 'BIGINT'),
                            ('new_business_premium', 'DECIMAL(38,4)'),
                            ('renewal_premium', 'DECIMAL(38,4)'),
                            ('renewal_rate_pct', 'DECIMAL(38,2)'),
                            ('effective_commission_rate_pct', 'DECIMAL(38,2)')],
 'prj_select_cast': [('order_id', 'BIGINT'),
                     ('customer_id', 'BIGINT'),
                     ('status', 'VARCHAR'),
                     ('total_price', 'DECIMAL(38,4)'),
                     ('order_date', 'DATE'),
                     ('priority', 'VARCHAR'),
                     ('is_filled', 'BOOLEAN'),
                     ('is_urgent', 'BOOLEAN')],
 'ringba_ae_calls_daily': [('call_date', 'DATE'),
                           ('account_executive', 'VARCHAR'),
                           ('partner_name', 'VARCHAR'),
                           ('ae_team', 'VARCHAR'),
                           ('ae_employee_type', 'VARCHAR'),
                           ('week_start', 'DATE'),
                           ('month_start', 'DATE'),
                           ('is_weekend', 'BOOLEAN'),
                           ('calls_routed', 'BIGINT'),
                           ('calls_dialed', 'BIGINT'),
                           ('calls_answered', 'BIGINT'),
                           ('calls_missed', 'BIGINT'),
                           ('missed_calls_answered_by_other', 'BIGINT'),
                           ('duplicate_calls_answered', 'BIGINT'),
                           ('no_answer_events', 'BIGINT'),
                           ('busy_events', 'BIGINT'),
                           ('answered_talk_seconds', 'BIGINT')],
 'ringba_calls_daily': [('call_date', 'DATE'),
                        ('partner_name', 'VARCHAR'),
                        ('campaign_name', 'VARCHAR'),
                        ('week_start', 'DATE'),
                        ('month_start', 'DATE'),
                        ('is_weekend', 'BOOLEAN'),
                        ('is_high_revenue_campaign', 'BOOLEAN'),
                        ('calls', 'BIGINT'),
                        ('routed_calls', 'BIGINT'),
                        ('answered_calls', 'BIGINT'),
                        ('missed_calls', 'BIGINT'),
                        ('unrouted_calls', 'BIGINT'),
                        ('duplicate_calls', 'BIGINT'),
                        ('no_target_found_calls', 'BIGINT'),
                        ('converted_calls', 'BIGINT'),
                        ('ae_dials', 'BIGINT'),
                        ('no_answer_events', 'BIGINT'),
                        ('total_seconds_to_answer', 'BIGINT'),
                        ('answered_talk_seconds', 'BIGINT')],
 'sc01_sc04_strings': [('c_custkey', 'BIGINT'),
                       ('clean_name', 'VARCHAR'),
                       ('upper_name', 'VARCHAR'),
                       ('name_and_segment', 'VARCHAR'),
                       ('segment_or_default', 'VARCHAR')],
 'sc06_json_key': [('event_id', 'BIGINT'), ('has_k', 'BOOLEAN'), ('has_x', 'BOOLEAN')],
 'sc07_json_text': [('event_id', 'BIGINT'), ('k_text', 'VARCHAR')],
 'sc08_date_trunc': [('o_orderkey', 'BIGINT'),
                     ('day_start', 'DATE'),
                     ('week_start', 'DATE'),
                     ('month_start', 'DATE'),
                     ('quarter_start', 'DATE'),
                     ('year_start', 'DATE')],
 'sc09_days_between': [('l_orderkey', 'BIGINT'), ('l_linenumber', 'BIGINT'), ('days_to_ship', 'BIGINT')],
 'sc10_interval_add': [('o_orderkey', 'BIGINT'), ('snapshot_at', 'TIMESTAMP'), ('plus_90_days', 'TIMESTAMP')],
 'sc11_utc_to_eastern': [('event_id', 'BIGINT'),
                         ('eastern_at', 'TIMESTAMP'),
                         ('eastern_date', 'DATE'),
                         ('utc_date', 'DATE')],
 'sc12_instant_to_eastern': [('event_id', 'BIGINT'), ('eastern_at', 'TIMESTAMP')],
 'sc13_as_of_age': [('o_orderkey', 'BIGINT'),
                    ('age_days', 'BIGINT'),
                    ('is_mature_d7', 'BIGINT'),
                    ('is_mature_d30', 'BIGINT'),
                    ('is_mature_d10000', 'BIGINT')],
 'sc15_seconds_between': [('user_id', 'BIGINT'), ('seconds_to_purchase', 'BIGINT')],
 'sc17_pct': [('p_brand', 'VARCHAR'), ('return_pct', 'DECIMAL(38,2)'), ('negated_total', 'DECIMAL(38,4)')],
 'sc19_bool_algebra': [('o_orderkey', 'BIGINT'),
                       ('is_big', 'BOOLEAN'),
                       ('big_and_urgent', 'BOOLEAN'),
                       ('big_or_urgent', 'BOOLEAN'),
                       ('not_big', 'BOOLEAN'),
                       ('is_big_or_false', 'BOOLEAN')],
 'sc_window_flags': [('l_orderkey', 'BIGINT'),
                     ('l_linenumber', 'BIGINT'),
                     ('d7', 'BIGINT'),
                     ('d30', 'BIGINT'),
                     ('d90', 'BIGINT')],
 'set01_union_all': [('day', 'DATE'), ('amount', 'DECIMAL(38,4)'), ('n_lines', 'BIGINT')],
 'src20_date_spine': [('date_day', 'DATE'),
                      ('week_start', 'DATE'),
                      ('month_start', 'DATE'),
                      ('quarter_start', 'DATE'),
                      ('year_start', 'DATE'),
                      ('year', 'BIGINT'),
                      ('quarter', 'BIGINT'),
                      ('month', 'BIGINT'),
                      ('year_month', 'VARCHAR'),
                      ('day_of_month', 'BIGINT'),
                      ('day_of_week', 'BIGINT'),
                      ('day_name', 'VARCHAR'),
                      ('is_weekend', 'BOOLEAN'),
                      ('is_month_end', 'BOOLEAN')],
 'srt01_order_nulls_first': [('n_name', 'VARCHAR'), ('revenue', 'DECIMAL(38,4)'), ('size_bucket', 'VARCHAR')],
 'stg_application_submission': [('application_submission_id', 'BIGINT'),
                                ('business_id', 'BIGINT'),
                                ('user_id', 'BIGINT'),
                                ('application_submission_batch_id', 'BIGINT'),
                                ('employee_contact_information_id', 'BIGINT'),
                                ('policy_type', 'VARCHAR'),
                                ('license_name', 'VARCHAR'),
                                ('status', 'VARCHAR'),
                                ('is_submitted', 'BOOLEAN'),
                                ('submission_source', 'VARCHAR'),
                                ('is_cross_sell', 'BOOLEAN'),
                                ('is_hybrid', 'BOOLEAN'),
                                ('is_admin_quoting_tool', 'BOOLEAN'),
                                ('is_admin_rater', 'BOOLEAN'),
                                ('is_manual_application', 'BOOLEAN'),
                                ('is_post_purchase_cross_sell', 'BOOLEAN'),
                                ('is_rate_call1', 'BOOLEAN'),
                                ('is_paygo', 'BOOLEAN'),
                                ('reminded', 'BOOLEAN'),
                                ('viewed', 'BOOLEAN'),
                                ('missing_fields', 'VARCHAR'),
                                ('created_at', 'TIMESTAMP'),
                                ('created_date', 'DATE'),
                                ('updated_at', 'TIMESTAMP'),
                                ('effective_date', 'DATE'),
                                ('expiry_date', 'DATE'),
                                ('viewed_at', 'TIMESTAMP')],
 'stg_business': [('business_id', 'BIGINT'),
                  ('user_id', 'BIGINT'),
                  ('business_classification_id', 'BIGINT'),
                  ('close_lead_id', 'VARCHAR'),
                  ('lead_originator_employee_id', 'BIGINT'),
                  ('created_at_cohort_id', 'BIGINT'),
                  ('business_name', 'VARCHAR'),
                  ('legal_entity_type', 'VARCHAR'),
                  ('company_type', 'VARCHAR'),
                  ('years_in_business', 'BIGINT'),
                  ('business_start_year', 'BIGINT'),
                  ('website', 'VARCHAR'),
                  ('total_annual_revenue', 'DOUBLE'),
                  ('total_annual_payroll', 'DOUBLE'),
                  ('total_number_of_employees', 'BIGINT'),
                  ('number_of_owner_officers', 'BIGINT'),
                  ('license_name', 'VARCHAR'),
                  ('warm_transfer_campaign', 'VARCHAR'),
                  ('campaign_type', 'VARCHAR'),
                  ('tivly_campaign', 'VARCHAR'),
                  ('partner_tracking_id', 'VARCHAR'),
                  ('is_qualified_partner_lead', 'BOOLEAN'),
                  ('qualified_partner_lead_at', 'TIMESTAMP'),
                  ('has_been_sold', 'BOOLEAN'),
                  ('account_executive', 'VARCHAR'),
                  ('account_manager', 'VARCHAR'),
                  ('sold_by', 'VARCHAR'),
                  ('credited_account_executive', 'VARCHAR'),
                  ('close_status', 'VARCHAR'),
                  ('close_junk_parent_reason', 'VARCHAR'),
                  ('close_junk_explanation', 'VARCHAR'),
                  ('is_high_risk', 'BOOLEAN'),
                  ('high_risk_reason', 'VARCHAR'),
                  ('is_test_flag', 'BOOLEAN'),
                  ('created_at', 'TIMESTAMP'),
                  ('created_date', 'DATE'),
                  ('created_week', 'DATE'),
                  ('created_month', 'DATE')],
 'stg_business_classification': [('business_classification_id', 'BIGINT'),
                                 ('classification_name', 'VARCHAR'),
                                 ('naics_code', 'VARCHAR'),
                                 ('industry', 'VARCHAR'),
                                 ('sub_industry', 'VARCHAR'),
                                 ('naics_sub_industry', 'VARCHAR'),
                                 ('sic_code', 'VARCHAR')],
 'stg_business_close_status_change': [('change_log_id', 'BIGINT'),
                                      ('business_id', 'BIGINT'),
                                      ('old_close_status', 'VARCHAR'),
                                      ('new_close_status', 'VARCHAR'),
                                      ('changed_by', 'VARCHAR'),
                                      ('created_at', 'TIMESTAMP')],
 'stg_campaign_status': [('campaign_status_id', 'BIGINT'),
                         ('partner_id', 'BIGINT'),
                         ('campaign_name', 'VARCHAR'),
                         ('campaign_external_id', 'VARCHAR'),
                         ('ringba_campaign_id', 'VARCHAR'),
                         ('bid_cost', 'DECIMAL(38,4)'),
                         ('is_available', 'BOOLEAN'),
                         ('is_tivly_campaign', 'BOOLEAN'),
                         ('is_high_revenue_campaign', 'BOOLEAN'),
                         ('contains_enterprise', 'BOOLEAN')],
 'stg_carrier': [('carrier_id', 'BIGINT'),
                 ('carrier_name', 'VARCHAR'),
                 ('carrier_group', 'VARCHAR'),
                 ('is_wholesaler', 'BOOLEAN'),
                 ('is_agency_bill', 'BOOLEAN'),
                 ('is_test_carrier', 'BOOLEAN')],
 'stg_employee_contact_information': [('employee_id', 'BIGINT'),
                                      ('employee_name', 'VARCHAR'),
                                      ('email', 'VARCHAR'),
                                      ('employee_type', 'VARCHAR'),
                                      ('team', 'VARCHAR'),
                                      ('operations_team', 'VARCHAR'),
                                      ('is_active', 'BOOLEAN'),
                                      ('is_belgrade_am', 'BOOLEAN'),
                                      ('start_date', 'DATE'),
                                      ('end_date', 'DATE')],
 'stg_lead': [('lead_id', 'BIGINT'),
              ('business_id', 'BIGINT'),
              ('user_id', 'BIGINT'),
              ('account_executive', 'VARCHAR'),
              ('workflow_type_assigned', 'VARCHAR'),
              ('previous_account_executives', 'VARCHAR'),
              ('score', 'BIGINT'),
              ('made_contact', 'BOOLEAN'),
              ('is_junk', 'BOOLEAN'),
              ('timer_paused', 'BOOLEAN'),
              ('is_currently_on_call_with_ae', 'BOOLEAN'),
              ('created_at', 'TIMESTAMP'),
              ('expiry_time', 'TIMESTAMP'),
              ('paused_time', 'TIMESTAMP')],
 'stg_license': [('license_id', 'BIGINT'),
                 ('license_name', 'VARCHAR'),
                 ('partner_id', 'BIGINT'),
                 ('parent_license_id', 'BIGINT'),
                 ('partner_name', 'VARCHAR'),
                 ('partner_profile_type', 'VARCHAR'),
                 ('transfer_type', 'VARCHAR'),
                 ('integration_type', 'VARCHAR'),
                 ('lead_intake_type', 'VARCHAR'),
                 ('policy_type', 'VARCHAR'),
                 ('company_type', 'VARCHAR'),
                 ('is_instant_pay_enabled', 'BOOLEAN'),
                 ('is_lead_selling_enabled', 'BOOLEAN'),
                 ('laq_priority', 'BIGINT'),
                 ('created_at', 'TIMESTAMP')],
 'stg_opportunity': [('opportunity_id', 'BIGINT'),
                     ('business_id', 'BIGINT'),
                     ('policy_id', 'BIGINT'),
                     ('close_opportunity_id', 'VARCHAR'),
                     ('employee_contact_information_id', 'BIGINT'),
                     ('policy_type', 'VARCHAR'),
                     ('status', 'VARCHAR'),
                     ('is_surplus_lines', 'BOOLEAN'),
                     ('confidence', 'BIGINT'),
                     ('description', 'VARCHAR'),
                     ('created_at', 'TIMESTAMP'),
                     ('updated_at', 'TIMESTAMP'),
                     ('status_last_updated_at', 'TIMESTAMP')],
 'stg_opportunity_status_history': [('opportunity_status_history_id', 'BIGINT'),
                                    ('opportunity_id', 'BIGINT'),
                                    ('business_id', 'BIGINT'),
                                    ('change_type', 'VARCHAR'),
                                    ('from_value', 'VARCHAR'),
                                    ('to_value', 'VARCHAR'),
                                    ('created_at', 'TIMESTAMP')],
 'stg_partner': [('partner_id', 'BIGINT'),
                 ('partner_name', 'VARCHAR'),
                 ('partner_profile_type', 'VARCHAR'),
                 ('is_paygo_enabled', 'BOOLEAN'),
                 ('created_at', 'TIMESTAMP')],
 'stg_policy': [('policy_id', 'BIGINT'),
                ('business_id', 'BIGINT'),
                ('carrier_id', 'BIGINT'),
                ('quote_id', 'BIGINT'),
                ('external_policy_id', 'VARCHAR'),
                ('close_opportunity_id', 'VARCHAR'),
                ('close_policy_id', 'VARCHAR'),
                ('renewed_from_policy_id', 'BIGINT'),
                ('policy_cancellation_reason_id', 'BIGINT'),
                ('policy_type', 'VARCHAR'),
                ('license_name', 'VARCHAR'),
                ('status', 'VARCHAR'),
                ('is_active', 'BOOLEAN'),
                ('billing_type', 'VARCHAR'),
                ('sale_type', 'VARCHAR'),
                ('is_new_business', 'BOOLEAN'),
                ('is_retained_sale_type', 'BOOLEAN'),
                ('sales_channel', 'VARCHAR'),
                ('underwriting_carrier', 'VARCHAR'),
                ('account_executive', 'VARCHAR'),
                ('assigned_agent', 'VARCHAR'),
                ('premium', 'DECIMAL(38,4)'),
                ('commissionable_premium', 'DECIMAL(38,4)'),
                ('commission_rate', 'DECIMAL(38,6)'),
                ('estimated_commission', 'DECIMAL(38,8)'),
                ('down_payment', 'DECIMAL(38,4)'),
                ('monthly_payment', 'DECIMAL(38,4)'),
                ('mmr_fee', 'DECIMAL(38,4)'),
                ('is_renewal', 'BOOLEAN'),
                ('renewal_count', 'BIGINT'),
                ('bor_renewal', 'BOOLEAN'),
                ('is_cancel_rewrite', 'BOOLEAN'),
                ('is_reinstated', 'BOOLEAN'),
                ('is_partial', 'BOOLEAN'),
                ('is_instant_pay', 'BOOLEAN'),
                ('is_paygo', 'BOOLEAN'),
                ('is_auto_bind', 'BOOLEAN'),
                ('cancellation_status', 'VARCHAR'),
                ('cancellation_date', 'DATE'),
                ('cancellation_effective_date', 'DATE'),
                ('cancellation_reason', 'VARCHAR'),
                ('reinstatement_date', 'DATE'),
                ('bor_away_status', 'VARCHAR'),
                ('bor_away_date', 'DATE'),
                ('effective_date', 'DATE'),
                ('expiry_date', 'DATE'),
                ('created_at', 'TIMESTAMP'),
                ('created_date', 'DATE'),
                ('updated_at', 'TIMESTAMP')],
 'stg_policy_status_change': [('change_log_id', 'BIGINT'),
                              ('policy_id', 'BIGINT'),
                              ('old_status', 'VARCHAR'),
                              ('new_status', 'VARCHAR'),
                              ('changed_by', 'VARCHAR'),
                              ('changed_at', 'TIMESTAMP')],
 'stg_policy_transaction': [('policy_transaction_id', 'BIGINT'),
                            ('policy_id', 'BIGINT'),
                            ('transaction_type', 'VARCHAR'),
                            ('direction', 'VARCHAR'),
                            ('status', 'VARCHAR'),
                            ('is_partial_installment', 'BOOLEAN'),
                            ('is_core_revenue', 'BOOLEAN'),
                            ('is_gross_revenue', 'BOOLEAN'),
                            ('is_cancellation', 'BOOLEAN'),
                            ('is_cancellation_driven', 'BOOLEAN'),
                            ('revenue_bucket', 'VARCHAR'),
                            ('is_parent', 'BOOLEAN'),
                            ('endorsement_reason', 'VARCHAR'),
                            ('description', 'VARCHAR'),
                            ('amount', 'DECIMAL(38,4)'),
                            ('signed_amount', 'DECIMAL(38,4)'),
                            ('total_amount', 'DECIMAL(38,4)'),
                            ('amount_received', 'DECIMAL(38,4)'),
                            ('rate', 'DECIMAL(38,6)'),
                            ('closed_out', 'BOOLEAN'),
                            ('created_at', 'TIMESTAMP'),
                            ('created_date', 'DATE'),
                            ('created_month', 'DATE'),
                            ('due_by', 'TIMESTAMP')],
 'stg_quote': [('quote_id', 'BIGINT'),
               ('business_id', 'BIGINT'),
               ('application_submission_id', 'BIGINT'),
               ('carrier_id', 'BIGINT'),
               ('opportunity_id', 'BIGINT'),
               ('license_name', 'VARCHAR'),
               ('policy_type', 'VARCHAR'),
               ('status', 'VARCHAR'),
               ('billing_type', 'VARCHAR'),
               ('payment_interval', 'VARCHAR'),
               ('is_instant_pay', 'BOOLEAN'),
               ('is_hybrid_pay', 'BOOLEAN'),
               ('is_manual', 'BOOLEAN'),
               ('is_visible', 'BOOLEAN'),
               ('underwriting_carrier', 'VARCHAR'),
               ('quoted_premium', 'DECIMAL(38,4)'),
               ('agency_fees', 'DECIMAL(38,4)'),
               ('taxes', 'DECIMAL(38,4)'),
               ('technology_fee', 'DECIMAL(38,4)'),
               ('policy_fee', 'DECIMAL(38,4)'),
               ('mmr_fee', 'DECIMAL(38,4)'),
               ('other_fees', 'DECIMAL(38,4)'),
               ('commission_rate', 'DECIMAL(38,6)'),
               ('down_payment', 'DECIMAL(38,4)'),
               ('installment_amount', 'DECIMAL(38,4)'),
               ('num_of_installments', 'BIGINT'),
               ('created_at', 'TIMESTAMP'),
               ('created_date', 'DATE'),
               ('created_at_utc', 'TIMESTAMP'),
               ('expires_at', 'TIMESTAMP')],
 'stg_ringba_call': [('ringba_call_id', 'BIGINT'),
                     ('inbound_call_id', 'VARCHAR'),
                     ('campaign_status_id', 'BIGINT'),
                     ('ringba_campaign_id', 'VARCHAR'),
                     ('caller_number', 'VARCHAR'),
                     ('has_connected', 'BOOLEAN'),
                     ('has_converted', 'BOOLEAN'),
                     ('call_length_seconds', 'BIGINT'),
                     ('called_at', 'TIMESTAMP'),
                     ('called_at_utc', 'TIMESTAMP'),
                     ('ingested_at', 'TIMESTAMP'),
                     ('call_date', 'DATE')],
 'stg_ringba_call_event': [('ringba_call_event_id', 'BIGINT'),
                           ('ringba_call_id', 'BIGINT'),
                           ('event_name', 'VARCHAR'),
                           ('target_id', 'VARCHAR'),
                           ('target_name', 'VARCHAR'),
                           ('target_number', 'VARCHAR'),
                           ('conversion_amount', 'DECIMAL(38,4)'),
                           ('fail_reason', 'VARCHAR'),
                           ('event_at', 'TIMESTAMP'),
                           ('event_at_utc', 'TIMESTAMP')],
 'stg_user': [('user_id', 'BIGINT'),
              ('email', 'VARCHAR'),
              ('first_name', 'VARCHAR'),
              ('last_name', 'VARCHAR'),
              ('full_name', 'VARCHAR'),
              ('phone', 'VARCHAR'),
              ('is_test_name', 'BOOLEAN'),
              ('is_active', 'BOOLEAN'),
              ('subscribed_to_emails', 'BOOLEAN'),
              ('created_at', 'TIMESTAMP'),
              ('last_login', 'TIMESTAMP')],
 'stg_warm_transfer': [('warm_transfer_id', 'BIGINT'),
                       ('business_id', 'BIGINT'),
                       ('campaign_status_id', 'BIGINT'),
                       ('external_business_id', 'VARCHAR'),
                       ('status', 'VARCHAR'),
                       ('is_accepted', 'BOOLEAN'),
                       ('is_rejected', 'BOOLEAN'),
                       ('is_error', 'BOOLEAN'),
                       ('is_received', 'BOOLEAN'),
                       ('claimed_status', 'VARCHAR'),
                       ('sold_by', 'VARCHAR'),
                       ('rejection_reason', 'VARCHAR'),
                       ('rejection_reason_category', 'VARCHAR'),
                       ('payload_vendor', 'VARCHAR'),
                       ('awl_campaign', 'VARCHAR'),
                       ('bid_price', 'DECIMAL(38,4)'),
                       ('created_at', 'TIMESTAMP'),
                       ('created_date', 'DATE'),
                       ('claimed_at', 'TIMESTAMP'),
                       ('laq_assigned_at', 'TIMESTAMP'),
                       ('updated_at', 'TIMESTAMP')],
 'win01_latest_per_key': [('o_custkey', 'BIGINT'), ('o_orderkey', 'BIGINT'), ('o_orderdate', 'TIMESTAMP')],
 'win02_first_in_month': [('order_date', 'DATE'), ('new_customers_in_month', 'BIGINT')],
 'win_earliest_per_key': [('user_id', 'BIGINT'), ('event_type', 'VARCHAR'), ('event_id', 'BIGINT')],
 'wt_pings_daily': [('ping_date', 'DATE'),
                    ('partner_name', 'VARCHAR'),
                    ('campaign_name', 'VARCHAR'),
                    ('status', 'VARCHAR'),
                    ('claimed_status', 'VARCHAR'),
                    ('rejection_reason_category', 'VARCHAR'),
                    ('rejection_reason', 'VARCHAR'),
                    ('credited_account_executive', 'VARCHAR'),
                    ('ping_week', 'DATE'),
                    ('ping_month', 'DATE'),
                    ('is_mature_d7', 'BIGINT'),
                    ('is_mature_d30', 'BIGINT'),
                    ('credited_ae_team', 'VARCHAR'),
                    ('is_high_revenue_campaign', 'BOOLEAN'),
                    ('ping_count', 'BIGINT'),
                    ('accepted_count', 'BIGINT'),
                    ('rejected_count', 'BIGINT'),
                    ('error_count', 'BIGINT'),
                    ('received_count', 'BIGINT'),
                    ('claimed_count', 'BIGINT'),
                    ('unclaimed_count', 'BIGINT'),
                    ('business_count', 'BIGINT'),
                    ('accepted_bid_price', 'DECIMAL(38,4)'),
                    ('offered_bid_price', 'DECIMAL(38,4)'),
                    ('quoted_business_count', 'BIGINT'),
                    ('d7_quoted_business_count', 'BIGINT'),
                    ('converted_business_count', 'BIGINT'),
                    ('d7_converted_business_count', 'BIGINT'),
                    ('d30_converted_business_count', 'BIGINT'),
                    ('nb_policy_count', 'BIGINT'),
                    ('nb_premium', 'DECIMAL(38,4)'),
                    ('d30_nb_premium', 'DECIMAL(38,4)'),
                    ('d30_nb_gross_revenue', 'DECIMAL(38,4)'),
                    ('nb_gross_revenue', 'DECIMAL(38,4)')],
 'wt_tracker_daily': [('business_created_date', 'DATE'),
                      ('license_name', 'VARCHAR'),
                      ('claimed_status', 'VARCHAR'),
                      ('warm_transfer_campaign', 'VARCHAR'),
                      ('credited_account_executive', 'VARCHAR'),
                      ('workflow_type', 'VARCHAR'),
                      ('business_created_week', 'DATE'),
                      ('business_created_month', 'DATE'),
                      ('is_mature_d7', 'BIGINT'),
                      ('is_mature_d14', 'BIGINT'),
                      ('is_mature_d30', 'BIGINT'),
                      ('partner_name', 'VARCHAR'),
                      ('transfer_type', 'VARCHAR'),
                      ('campaign_type', 'VARCHAR'),
                      ('credited_ae_team', 'VARCHAR'),
                      ('business_count', 'BIGINT'),
                      ('total_bid_price', 'DECIMAL(38,4)'),
                      ('d7_attempted_to_contact_business_count', 'BIGINT'),
                      ('d7_made_contact_business_count', 'BIGINT'),
                      ('d7_junk_business_count', 'BIGINT'),
                      ('quoted_business_count', 'BIGINT'),
                      ('d7_quoted_business_count', 'BIGINT'),
                      ('d30_quoted_business_count', 'BIGINT'),
                      ('total_days_to_d30_quote', 'BIGINT'),
                      ('d7_quote_presented_business_count', 'BIGINT'),
                      ('quote_count', 'BIGINT'),
                      ('converted_business_count', 'BIGINT'),
                      ('d1_converted_business_count', 'BIGINT'),
                      ('d7_converted_business_count', 'BIGINT'),
                      ('d14_converted_business_count', 'BIGINT'),
                      ('d30_converted_business_count', 'BIGINT'),
                      ('d60_converted_business_count', 'BIGINT'),
                      ('d90_converted_business_count', 'BIGINT'),
                      ('nb_policy_count', 'BIGINT'),
                      ('nb_premium', 'DECIMAL(38,4)'),
                      ('d30_nb_premium', 'DECIMAL(38,4)'),
                      ('d7_nb_gross_revenue', 'DECIMAL(38,4)'),
                      ('d14_nb_gross_revenue', 'DECIMAL(38,4)'),
                      ('d30_nb_gross_revenue', 'DECIMAL(38,4)'),
                      ('nb_gross_revenue', 'DECIMAL(38,4)'),
                      ('d30_nb_core_revenue', 'DECIMAL(38,4)'),
                      ('nb_cancellation_amount', 'DECIMAL(38,4)'),
                      ('d7_chubb_quoted_business_count', 'BIGINT'),
                      ('d7_chubb_quoted_premium', 'DECIMAL(38,4)'),
                      ('d7_chubb_converted_business_count', 'BIGINT'),
                      ('d30_chubb_converted_business_count', 'BIGINT'),
                      ('d30_nb_chubb_premium', 'DECIMAL(38,4)'),
                      ('d30_nb_chubb_gross_revenue', 'DECIMAL(38,4)'),
                      ('d7_gaig_quoted_business_count', 'BIGINT'),
                      ('d7_gaig_quoted_premium', 'DECIMAL(38,4)'),
                      ('d7_gaig_converted_business_count', 'BIGINT'),
                      ('d30_gaig_converted_business_count', 'BIGINT'),
                      ('d30_nb_gaig_premium', 'DECIMAL(38,4)'),
                      ('d30_nb_gaig_gross_revenue', 'DECIMAL(38,4)')]}
