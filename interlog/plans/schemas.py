"""Generated by tools/gen_schemas.py: Spark output schema of each registered query."""

SCHEMAS = {'add_columns': [('row_id', 'bigint'), ('ac_rollsum', 'bigint'), ('r_rollcnt', 'smallint'), ('w', 'double')],
 'append_mean_embedding': [('id', 'bigint'), ('vector', 'string'), ('bias', 'double')],
 'apply_folds': [('row_id', 'bigint'), ('fold', 'bigint')],
 'argmax_row_join': [('user_id', 'bigint'),
                     ('row_id', 'bigint'),
                     ('ts_delta', 'bigint'),
                     ('timestamp', 'bigint'),
                     ('content_id', 'bigint')],
 'array_membership_join': [('tag', 'bigint'), ('ac', 'bigint'), ('r', 'bigint'), ('ql_id', 'bigint')],
 'asof_session': [('row_id', 'bigint'),
                  ('session', 'bigint'),
                  ('ac_cumsum_session', 'bigint'),
                  ('r_cumcnt_session', 'bigint'),
                  ('ac_cumsum_pct_session', 'bigint'),
                  ('l_cumcnt_session', 'bigint'),
                  ('pqet_cumsum_session', 'bigint'),
                  ('pqet_cumavg_session', 'bigint')],
 'asof_tags': [('row_id', 'bigint'),
               ('ac_cumsum_tags', 'bigint'),
               ('r_cumcnt_tags', 'bigint'),
               ('ac_cumsum_pct_tags', 'bigint'),
               ('l_cumcnt_tags', 'bigint'),
               ('pqet_cumsum_tags', 'bigint'),
               ('pqet_cumavg_tags', 'bigint'),
               ('ac_cumsum_part_tags', 'bigint'),
               ('r_cumcnt_part_tags', 'bigint'),
               ('ac_cumsum_pct_part_tags', 'bigint'),
               ('l_cumcnt_part_tags', 'bigint'),
               ('pqet_cumsum_part_tags', 'bigint'),
               ('pqet_cumavg_part_tags', 'bigint')],
 'asof_upto': [('row_id', 'bigint'),
               ('ac_cumsum_upto', 'bigint'),
               ('r_cumcnt_upto', 'bigint'),
               ('ac_cumsum_pct_upto', 'bigint'),
               ('pqet_cumsum_upto', 'bigint'),
               ('pqet_cumavg_upto', 'bigint')],
 'asof_user_content_part': [('row_id', 'bigint'),
                            ('user_id', 'bigint'),
                            ('task_container_id', 'bigint'),
                            ('ac_cumsum', 'bigint'),
                            ('r_cumcnt', 'bigint'),
                            ('ac_cumsum_pct', 'bigint'),
                            ('l_cumcnt', 'bigint'),
                            ('pqet_cumsum', 'bigint'),
                            ('pqet_cumavg', 'bigint'),
                            ('ac_cumsum_content_id', 'bigint'),
                            ('r_cumcnt_content_id', 'bigint'),
                            ('ac_cumsum_pct_content_id', 'bigint'),
                            ('pqet_cumsum_content_id', 'bigint'),
                            ('pqet_cumavg_content_id', 'bigint'),
                            ('ac_cumsum_part', 'bigint'),
                            ('r_cumcnt_part', 'bigint'),
                            ('ac_cumsum_pct_part', 'bigint'),
                            ('l_cumcnt_part', 'bigint'),
                            ('pqet_cumsum_part', 'bigint'),
                            ('pqet_cumavg_part', 'bigint'),
                            ('r_cumcnt_clip', 'bigint')],
 'assign_ql_id': [('row_id', 'bigint'), ('ql_id', 'bigint')],
 'attach_delayed_answers': [('row_id', 'bigint'), ('answered_correctly', 'bigint')],
 'average_ensemble': [('row_id', 'bigint'), ('answered_correctly', 'double')],
 'canonical_sort': [('row_id', 'bigint'), ('user_id', 'bigint'), ('task_container_id', 'bigint')],
 'clip_count': [('row_id', 'bigint'), ('r_cumcnt_clip30', 'bigint')],
 'container_rollup': [('user_id', 'bigint'),
                      ('task_container_id_q', 'bigint'),
                      ('ts_delta_max', 'bigint'),
                      ('ac_pct', 'bigint'),
                      ('pqet_max', 'double')],
 'content_correct_pct_part': [('ql_id', 'bigint'), ('part_correct_pct', 'bigint')],
 'content_correct_pct_question_id': [('ql_id', 'bigint'), ('question_id_correct_pct', 'bigint')],
 'content_dimension': [('ql_id', 'bigint'),
                       ('question_id', 'bigint'),
                       ('lecture_id', 'bigint'),
                       ('bundle_id', 'bigint'),
                       ('correct_answer', 'bigint'),
                       ('part', 'bigint'),
                       ('tags', 'string'),
                       ('tags_array', 'string'),
                       ('tags_code', 'bigint')],
 'content_elapsed_avg_part': [('ql_id', 'bigint'), ('part_pqet_avg', 'bigint')],
 'content_elapsed_avg_question_id': [('ql_id', 'bigint'), ('question_id_pqet_avg', 'bigint')],
 'content_part_tag_totals': [('ql_id', 'bigint'),
                             ('part_tags_correct_pct', 'bigint'),
                             ('part_tags_pqet_avg', 'bigint')],
 'content_tag_pairs': [('question_id', 'bigint'), ('part', 'bigint'), ('tag_0', 'bigint'), ('tag', 'bigint')],
 'content_tag_totals': [('ql_id', 'bigint'), ('tags_correct_pct', 'bigint'), ('tags_pqet_avg', 'bigint')],
 'content_user_correlation': [('content_id', 'bigint'),
                              ('r_cumcnt', 'bigint'),
                              ('ac_cumsum_pct', 'double'),
                              ('corr', 'double')],
 'cumulative_share': [('content_id', 'bigint'), ('r_cumcnt', 'bigint'), ('cum_share', 'double')],
 'dataset_checks': [('n_lectures', 'bigint'),
                    ('n_lecture_answers', 'bigint'),
                    ('n_question_nulls', 'bigint')],
 'distinct_tags': [('tags', 'string')],
 'elapsed_current': [('row_id', 'bigint'), ('pqet_current', 'bigint')],
 'embedding_logit': [('row_id', 'bigint'), ('pred_collab_logit', 'double'), ('pred_collab', 'double')],
 'encode_ids': [('row_id', 'bigint'), ('user_id_code', 'bigint'), ('content_id_code', 'bigint')],
 'ensure_database': [('ql_id', 'bigint'), ('part', 'bigint')],
 'ewma_ac_pct': [('row_id_e', 'bigint'),
                 ('ac_pct_ewma_01', 'bigint'),
                 ('ac_pct_ewma_05', 'bigint'),
                 ('ac_pct_ewma_10', 'bigint'),
                 ('ac_pct_ewma_20', 'bigint'),
                 ('ac_pct_ewma_50', 'bigint')],
 'ewma_l_cnt': [('row_id_e', 'bigint'),
                ('l_cnt_ewma_01', 'bigint'),
                ('l_cnt_ewma_05', 'bigint'),
                ('l_cnt_ewma_10', 'bigint'),
                ('l_cnt_ewma_20', 'bigint'),
                ('l_cnt_ewma_50', 'bigint')],
 'ewma_pqet': [('row_id_e', 'bigint'),
               ('pqet_ewma_01', 'bigint'),
               ('pqet_ewma_05', 'bigint'),
               ('pqet_ewma_10', 'bigint'),
               ('pqet_ewma_20', 'bigint'),
               ('pqet_ewma_50', 'bigint')],
 'ewma_weight_table': [('offset', 'int'), ('alpha', 'int'), ('weight', 'double'), ('n_containers', 'bigint')],
 'ewma_ts_delta': [('row_id_e', 'bigint'),
                   ('ts_delta_ewma_01', 'bigint'),
                   ('ts_delta_ewma_05', 'bigint'),
                   ('ts_delta_ewma_10', 'bigint'),
                   ('ts_delta_ewma_20', 'bigint'),
                   ('ts_delta_ewma_50', 'bigint')],
 'export_query': [('row_id', 'bigint'), ('ac_cumsum', 'bigint'), ('r_cumcnt', 'bigint')],
 'factorization_train': [('id', 'bigint'), ('rank', 'int')],
 'feature_importance': [('feature', 'string'), ('importance', 'double'), ('cum_share', 'double')],
 'feature_registry': [('row_id', 'bigint'),
                      ('timestamp', 'bigint'),
                      ('part', 'bigint'),
                      ('prior_question_elapsed_time', 'double'),
                      ('prior_question_had_explanation', 'boolean'),
                      ('ac_cumsum', 'bigint'),
                      ('r_cumcnt', 'bigint'),
                      ('ac_cumsum_pct', 'bigint'),
                      ('l_cumcnt', 'bigint'),
                      ('pqet_cumavg', 'bigint'),
                      ('ac_cumsum_pct_content_id', 'bigint'),
                      ('r_cumcnt_content_id', 'bigint'),
                      ('ac_cumsum_pct_part', 'bigint'),
                      ('ac_cumsum_pct_tags', 'bigint'),
                      ('ac_cumsum_pct_part_tags', 'bigint'),
                      ('ac_cumsum_pct_session', 'bigint'),
                      ('r_cumcnt_session', 'bigint'),
                      ('ac_cumsum_pct_upto', 'bigint'),
                      ('ts_delta', 'bigint')],
 'fill_missing': [('row_id', 'bigint'),
                  ('prior_question_elapsed_time', 'double'),
                  ('prior_question_had_explanation', 'boolean')],
 'first_row_per_container': [('user_id', 'bigint'), ('task_container_id', 'bigint'), ('min_row', 'bigint')],
 'fold_export': [('answered_correctly', 'bigint'),
                 ('ac_cumsum_pct', 'bigint'),
                 ('r_cumcnt', 'bigint'),
                 ('fold', 'bigint')],
 'fold_runs': [('run', 'int'), ('split', 'string'), ('n', 'bigint')],
 'foreach_batch_scoring': [('row_id', 'bigint'), ('epoch', 'int'), ('answered_correctly', 'double')],
 'gbt_train_score': [('row_id', 'bigint'), ('prob', 'double')],
 'history_before_fold': [('row_id', 'bigint'),
                         ('user_id', 'bigint'),
                         ('content_id', 'bigint'),
                         ('answered_correctly', 'bigint')],
 'keep_original_container': [('row_id', 'bigint'), ('tid_orig', 'bigint')],
 'known_ids_filter': [('row_id', 'bigint')],
 'latest_per_user_content': [('row_id', 'bigint'),
                             ('user_id', 'bigint'),
                             ('content_id', 'bigint'),
                             ('answered_correctly', 'bigint')],
 'lecture_rows': [('row_id', 'bigint'), ('content_id', 'bigint')],
 'limit_rows': [('row_id', 'bigint'), ('user_id', 'bigint')],
 'linear_train_score': [('row_id', 'bigint'), ('prob', 'double')],
 'load_csv': [('row_id', 'bigint'),
              ('timestamp', 'bigint'),
              ('user_id', 'bigint'),
              ('content_id', 'bigint'),
              ('content_type_id', 'bigint'),
              ('answered_correctly', 'bigint'),
              ('prior_question_elapsed_time', 'double'),
              ('prior_question_had_explanation', 'boolean')],
 'log_features': [('row_id', 'bigint'), ('timestamp_log', 'double'), ('r_cumcnt_log', 'double')],
 'log_odds': [('row_id', 'bigint'), ('ac_cumsum_log_odds', 'double')],
 'logloss_error': [('split', 'string'), ('logloss', 'double'), ('error', 'double'), ('n', 'bigint')],
 'make_folds': [('user_id_s', 'bigint'),
                ('fold', 'bigint'),
                ('seq_start', 'string'),
                ('task_container_id_max', 'bigint'),
                ('task_container_id_min', 'bigint')],
 'merge_max_container': [('row_id', 'bigint'), ('task_container_id_max', 'bigint')],
 'min_history_filter': [('row_id', 'bigint'), ('user_id', 'bigint')],
 'pad_sequences_first': [('user_id', 'bigint'), ('content_id', 'string'), ('answered_correctly', 'string')],
 'pad_sequences_last': [('user_id', 'bigint'), ('content_id', 'string'), ('answered_correctly', 'string')],
 'padded_tags': [('question_id', 'bigint'),
                 ('tag_0', 'bigint'),
                 ('tag_1', 'bigint'),
                 ('tag_2', 'bigint'),
                 ('tag_3', 'bigint'),
                 ('tag_4', 'bigint'),
                 ('tag_5', 'bigint')],
 'prediction_scorecard': [('auc', 'double'), ('n_pos', 'bigint'), ('n_neg', 'bigint')],
 'prior_rows_join': [('row_id', 'bigint'),
                     ('answered_correctly_rollsum', 'bigint'),
                     ('roll_count', 'bigint')],
 'quantile_histogram': [('bin', 'int'), ('lower', 'double'), ('upper', 'double'), ('n', 'bigint')],
 'question_rows': [('row_id', 'bigint'), ('content_id', 'bigint')],
 'ratio_index': [('row_id', 'bigint'),
                 ('ac_cumsum_pct_content_id_idx', 'double'),
                 ('ac_cumsum_pct_part_idx', 'double'),
                 ('ac_cumsum_pct_part_tags_idx', 'double'),
                 ('pqet_cumavg_content_id_idx', 'double'),
                 ('pqet_cumavg_part_idx', 'double'),
                 ('pqet_cumavg_part_tags_idx', 'double')],
 'read_exported': [('user_id', 'bigint'),
                   ('tag', 'bigint'),
                   ('ac_cumsum_tag', 'bigint'),
                   ('r_cumcnt_tag', 'bigint')],
 'read_table': [('ql_id', 'bigint'), ('question_id', 'bigint'), ('part', 'bigint'), ('tags', 'string')],
 'rerank_containers': [('row_id', 'bigint'), ('task_container_id', 'bigint')],
 'rerank_containers_questions': [('row_id', 'bigint'), ('task_container_id_q', 'bigint')],
 'roc_auc': [('auc', 'double'), ('n_pos', 'bigint'), ('n_neg', 'bigint')],
 'rolling_container_stats': [('row_id_r', 'bigint'),
                             ('ts_delta_rollavg_001', 'bigint'),
                             ('pqet_rollavg_001', 'bigint'),
                             ('ac_rollsum_pct_001', 'bigint'),
                             ('l_rollcnt_001', 'bigint'),
                             ('ts_delta_rollavg_003', 'bigint'),
                             ('pqet_rollavg_003', 'bigint'),
                             ('ac_rollsum_pct_003', 'bigint'),
                             ('l_rollcnt_003', 'bigint'),
                             ('ts_delta_rollavg_005', 'bigint'),
                             ('pqet_rollavg_005', 'bigint'),
                             ('ac_rollsum_pct_005', 'bigint'),
                             ('l_rollcnt_005', 'bigint'),
                             ('ts_delta_rollavg_010', 'bigint'),
                             ('pqet_rollavg_010', 'bigint'),
                             ('ac_rollsum_pct_010', 'bigint'),
                             ('l_rollcnt_010', 'bigint'),
                             ('ts_delta_rollavg_020', 'bigint'),
                             ('pqet_rollavg_020', 'bigint'),
                             ('ac_rollsum_pct_020', 'bigint'),
                             ('l_rollcnt_020', 'bigint'),
                             ('ts_delta_rollavg_050', 'bigint'),
                             ('pqet_rollavg_050', 'bigint'),
                             ('ac_rollsum_pct_050', 'bigint'),
                             ('l_rollcnt_050', 'bigint'),
                             ('ts_delta_rollavg_100', 'bigint'),
                             ('pqet_rollavg_100', 'bigint'),
                             ('ac_rollsum_pct_100', 'bigint'),
                             ('l_rollcnt_100', 'bigint'),
                             ('ts_delta_rollavg_200', 'bigint'),
                             ('pqet_rollavg_200', 'bigint'),
                             ('ac_rollsum_pct_200', 'bigint'),
                             ('l_rollcnt_200', 'bigint')],
 'rolling_time_stats': [('row_id_r', 'bigint'),
                        ('ts_delta_rollavg_00001', 'bigint'),
                        ('pqet_rollavg_00001', 'bigint'),
                        ('ac_rollsum_pct_00001', 'bigint'),
                        ('r_rollcnt_00001', 'bigint'),
                        ('l_rollcnt_00001', 'bigint'),
                        ('ts_delta_rollavg_00005', 'bigint'),
                        ('pqet_rollavg_00005', 'bigint'),
                        ('ac_rollsum_pct_00005', 'bigint'),
                        ('r_rollcnt_00005', 'bigint'),
                        ('l_rollcnt_00005', 'bigint'),
                        ('ts_delta_rollavg_00010', 'bigint'),
                        ('pqet_rollavg_00010', 'bigint'),
                        ('ac_rollsum_pct_00010', 'bigint'),
                        ('r_rollcnt_00010', 'bigint'),
                        ('l_rollcnt_00010', 'bigint'),
                        ('ts_delta_rollavg_00060', 'bigint'),
                        ('pqet_rollavg_00060', 'bigint'),
                        ('ac_rollsum_pct_00060', 'bigint'),
                        ('r_rollcnt_00060', 'bigint'),
                        ('l_rollcnt_00060', 'bigint'),
                        ('ts_delta_rollavg_00300', 'bigint'),
                        ('pqet_rollavg_00300', 'bigint'),
                        ('ac_rollsum_pct_00300', 'bigint'),
                        ('r_rollcnt_00300', 'bigint'),
                        ('l_rollcnt_00300', 'bigint'),
                        ('ts_delta_rollavg_01440', 'bigint'),
                        ('pqet_rollavg_01440', 'bigint'),
                        ('ac_rollsum_pct_01440', 'bigint'),
                        ('r_rollcnt_01440', 'bigint'),
                        ('l_rollcnt_01440', 'bigint'),
                        ('ts_delta_rollavg_10800', 'bigint'),
                        ('pqet_rollavg_10800', 'bigint'),
                        ('ac_rollsum_pct_10800', 'bigint'),
                        ('r_rollcnt_10800', 'bigint'),
                        ('l_rollcnt_10800', 'bigint'),
                        ('ts_delta_rollavg_43200', 'bigint'),
                        ('pqet_rollavg_43200', 'bigint'),
                        ('ac_rollsum_pct_43200', 'bigint'),
                        ('r_rollcnt_43200', 'bigint'),
                        ('l_rollcnt_43200', 'bigint')],
 'safe_pct': [('row_id', 'bigint'), ('pct_content_id', 'bigint'), ('avg_pqet', 'bigint')],
 'select_features': [('row_id', 'bigint'),
                     ('user_id', 'bigint'),
                     ('fold', 'bigint'),
                     ('answered_correctly', 'bigint'),
                     ('timestamp', 'bigint'),
                     ('part', 'bigint'),
                     ('prior_question_elapsed_time', 'double'),
                     ('prior_question_had_explanation', 'boolean'),
                     ('ac_cumsum', 'bigint'),
                     ('r_cumcnt', 'bigint'),
                     ('ac_cumsum_pct', 'bigint'),
                     ('l_cumcnt', 'bigint'),
                     ('pqet_cumavg', 'bigint'),
                     ('r_cumcnt_clip', 'bigint'),
                     ('ac_cumsum_pct_content_id', 'bigint'),
                     ('r_cumcnt_content_id', 'bigint'),
                     ('ac_cumsum_pct_part', 'bigint'),
                     ('ac_cumsum_pct_tags', 'bigint'),
                     ('ac_cumsum_pct_part_tags', 'bigint'),
                     ('session', 'bigint'),
                     ('ac_cumsum_pct_session', 'bigint'),
                     ('r_cumcnt_session', 'bigint'),
                     ('ac_cumsum_pct_upto', 'bigint'),
                     ('ts_delta', 'bigint')],
 'sequence_targets': [('user_id', 'bigint'),
                      ('label', 'double'),
                      ('resp_prior', 'string'),
                      ('mask', 'string')],
 'shard_export': [('split', 'string'), ('n_rows', 'bigint'), ('within_limit', 'boolean')],
 'shuffle_rows': [('row_id', 'bigint'), ('user_id', 'bigint')],
 'split_counts': [('fold', 'bigint'), ('n', 'bigint')],
 'state_lookup': [('row_id', 'bigint'),
                  ('user_id', 'bigint'),
                  ('content_id', 'bigint'),
                  ('ts_minute', 'bigint'),
                  ('pqet_sec', 'bigint'),
                  ('r_cumcnt_clip', 'bigint'),
                  ('session', 'bigint'),
                  ('ac_cumsum_session', 'bigint'),
                  ('r_cumcnt_session', 'bigint'),
                  ('l_cumcnt_session', 'bigint'),
                  ('ac_cumsum_pct_session', 'bigint'),
                  ('ac_cumsum', 'bigint'),
                  ('ac_cumsum_pct', 'bigint'),
                  ('r_cumcnt', 'bigint'),
                  ('l_cumcnt', 'bigint'),
                  ('ac_cumsum_upto', 'bigint'),
                  ('ac_cumsum_pct_upto', 'bigint'),
                  ('r_cumcnt_upto', 'bigint'),
                  ('ac_cumsum_content_id', 'bigint'),
                  ('ac_cumsum_pct_content_id', 'bigint'),
                  ('r_cumcnt_content_id', 'bigint'),
                  ('ac_cumsum_tag_0', 'bigint'),
                  ('ac_cumsum_pct_tag_0', 'bigint'),
                  ('r_cumcnt_tag_0', 'bigint'),
                  ('l_cumcnt_tag_0', 'bigint'),
                  ('ac_cumsum_tags', 'bigint'),
                  ('r_cumcnt_tags', 'bigint'),
                  ('l_cumcnt_tags', 'bigint'),
                  ('ac_cumsum_pct_tags', 'bigint'),
                  ('ac_cumsum_part', 'bigint'),
                  ('ac_cumsum_pct_part', 'bigint'),
                  ('r_cumcnt_part', 'bigint'),
                  ('l_cumcnt_part', 'bigint'),
                  ('part', 'bigint'),
                  ('tag_0', 'bigint')],
 'streaming_asof_features': [('row_id', 'bigint'),
                             ('user_id', 'bigint'),
                             ('ac_cumsum', 'bigint'),
                             ('r_cumcnt', 'bigint'),
                             ('l_cumcnt', 'bigint'),
                             ('pqet_cumsum', 'bigint'),
                             ('ac_cumsum_pct', 'bigint'),
                             ('pqet_cumavg', 'bigint')],
 'table_profile_size': [('table_name', 'string'), ('n_files', 'bigint'), ('size_bytes', 'bigint')],
 'table_profile': [('table_name', 'string'), ('n_columns', 'bigint'), ('n_rows', 'bigint')],
 'tag_response': [('user_id', 'bigint'),
                  ('row_id', 'bigint'),
                  ('task_container_id', 'bigint'),
                  ('task_container_id_q', 'bigint'),
                  ('ql_id', 'bigint'),
                  ('content_type_id', 'bigint'),
                  ('part', 'bigint'),
                  ('tag', 'bigint'),
                  ('answered_correctly', 'bigint'),
                  ('pqet_current', 'bigint')],
 'tags_code': [('ql_id', 'bigint'), ('tags', 'string'), ('tags_code', 'bigint')],
 'time_units': [('row_id', 'bigint'), ('ts_minute', 'bigint'), ('pqet_sec', 'bigint')],
 'top_content_cumsums': [('row_id_tc', 'bigint'),
                         ('ac_cumsum_top_cid_3', 'bigint'),
                         ('ac_cumsum_top_cid_17', 'bigint'),
                         ('ac_cumsum_top_cid_42', 'bigint'),
                         ('ac_cumsum_top_cid_64', 'bigint'),
                         ('ac_cumsum_top_cid_99', 'bigint'),
                         ('r_cumcnt_top_cid_3', 'bigint'),
                         ('r_cumcnt_top_cid_17', 'bigint'),
                         ('r_cumcnt_top_cid_42', 'bigint'),
                         ('r_cumcnt_top_cid_64', 'bigint'),
                         ('r_cumcnt_top_cid_99', 'bigint'),
                         ('ac_cumsum_pct_top_cid_3', 'bigint'),
                         ('ac_cumsum_pct_top_cid_17', 'bigint'),
                         ('ac_cumsum_pct_top_cid_42', 'bigint'),
                         ('ac_cumsum_pct_top_cid_64', 'bigint'),
                         ('ac_cumsum_pct_top_cid_99', 'bigint')],
 'top_k': [('content_id', 'bigint'), ('corr', 'double')],
 'trailing_records': [('user_id', 'bigint'),
                      ('task_container_id', 'bigint'),
                      ('row_id', 'bigint'),
                      ('content_type_id', 'bigint'),
                      ('timestamp', 'bigint'),
                      ('answered_correctly', 'bigint'),
                      ('prior_question_elapsed_time', 'double'),
                      ('ts_delta', 'bigint')],
 'train_transforms': [('row_id', 'bigint'),
                      ('timestamp', 'bigint'),
                      ('user_id', 'bigint'),
                      ('content_id', 'bigint'),
                      ('content_type_id', 'bigint'),
                      ('task_container_id', 'bigint'),
                      ('task_container_id_q', 'bigint'),
                      ('tid_orig', 'bigint'),
                      ('answered_correctly', 'bigint'),
                      ('prior_question_elapsed_time', 'double'),
                      ('prior_question_had_explanation', 'boolean'),
                      ('ql_id', 'bigint'),
                      ('pqet_current', 'bigint'),
                      ('ts_delta', 'bigint')],
 'train_valid_split': [('row_id', 'bigint'), ('split', 'string')],
 'ts_delta': [('row_id', 'bigint'), ('ts_delta', 'bigint')],
 'typed_snapshot': [('row_id', 'bigint'),
                    ('ts_delta', 'int'),
                    ('pqet_current', 'int'),
                    ('ac_cumsum_pct', 'smallint'),
                    ('ts_delta_64', 'bigint')],
 'union_all': [('row_id', 'bigint'), ('content_type_id', 'bigint')],
 'upsert_lecture_state': [('user_id', 'bigint'),
                          ('ac_cumsum', 'bigint'),
                          ('aic_cumsum', 'bigint'),
                          ('r_cumcnt', 'bigint'),
                          ('l_cumcnt', 'bigint'),
                          ('ac_cumsum_upto', 'bigint'),
                          ('aic_cumsum_upto', 'bigint'),
                          ('r_cumcnt_upto', 'bigint'),
                          ('ac_cumsum_session', 'bigint'),
                          ('aic_cumsum_session', 'bigint'),
                          ('r_cumcnt_session', 'bigint'),
                          ('l_cumcnt_session', 'bigint'),
                          ('timestamp', 'bigint'),
                          ('session', 'bigint')],
 'upsert_part_state': [('user_id', 'bigint'),
                       ('part', 'bigint'),
                       ('ac_cumsum_part', 'bigint'),
                       ('aic_cumsum_part', 'bigint'),
                       ('r_cumcnt_part', 'bigint'),
                       ('l_cumcnt_part', 'bigint')],
 'upsert_question_state': [('user_id', 'bigint'),
                           ('ac_cumsum', 'bigint'),
                           ('aic_cumsum', 'bigint'),
                           ('r_cumcnt', 'bigint'),
                           ('l_cumcnt', 'bigint'),
                           ('ac_cumsum_upto', 'bigint'),
                           ('aic_cumsum_upto', 'bigint'),
                           ('r_cumcnt_upto', 'bigint'),
                           ('ac_cumsum_session', 'bigint'),
                           ('aic_cumsum_session', 'bigint'),
                           ('r_cumcnt_session', 'bigint'),
                           ('l_cumcnt_session', 'bigint'),
                           ('timestamp', 'bigint'),
                           ('session', 'bigint')],
 'upsert_user_state': [('user_id', 'bigint'),
                       ('ac_cumsum', 'bigint'),
                       ('aic_cumsum', 'bigint'),
                       ('r_cumcnt', 'bigint'),
                       ('l_cumcnt', 'bigint'),
                       ('ac_cumsum_upto', 'bigint'),
                       ('aic_cumsum_upto', 'bigint'),
                       ('r_cumcnt_upto', 'bigint'),
                       ('ac_cumsum_session', 'bigint'),
                       ('aic_cumsum_session', 'bigint'),
                       ('r_cumcnt_session', 'bigint'),
                       ('l_cumcnt_session', 'bigint'),
                       ('timestamp', 'bigint'),
                       ('session', 'bigint')],
 'user_container_bounds': [('user_id', 'bigint'),
                           ('task_container_id_min', 'bigint'),
                           ('task_container_id_max', 'bigint')],
 'user_content_state': [('user_id', 'bigint'),
                        ('content_id', 'bigint'),
                        ('ac_cumsum_content_id', 'bigint'),
                        ('r_cumcnt_content_id', 'bigint'),
                        ('l_cumcnt_content_id', 'bigint'),
                        ('pqet_cumsum_content_id', 'bigint')],
 'user_final_state': [('user_id', 'bigint'),
                      ('row_id', 'bigint'),
                      ('task_container_id', 'bigint'),
                      ('timestamp', 'bigint'),
                      ('session', 'bigint'),
                      ('ac_cumsum', 'bigint'),
                      ('r_cumcnt', 'bigint'),
                      ('l_cumcnt', 'bigint'),
                      ('pqet_cumsum', 'bigint'),
                      ('r_cumcnt_clip', 'bigint'),
                      ('ts_delta', 'bigint'),
                      ('ac_cumsum_upto', 'bigint'),
                      ('r_cumcnt_upto', 'bigint'),
                      ('l_cumcnt_upto', 'bigint'),
                      ('pqet_cumsum_upto', 'bigint'),
                      ('ac_cumsum_session', 'bigint'),
                      ('r_cumcnt_session', 'bigint'),
                      ('l_cumcnt_session', 'bigint'),
                      ('pqet_cumsum_session', 'bigint')],
 'user_history_slice': [('row_id', 'bigint'),
                        ('timestamp_hours', 'double'),
                        ('answered_correctly', 'bigint'),
                        ('ac_cumsum_pct', 'bigint')],
 'user_part_state': [('user_id', 'bigint'),
                     ('part', 'bigint'),
                     ('ac_cumsum_part', 'bigint'),
                     ('r_cumcnt_part', 'bigint'),
                     ('l_cumcnt_part', 'bigint'),
                     ('pqet_cumsum_part', 'bigint')],
 'user_part_tag_state': [('user_id', 'bigint'),
                         ('part', 'bigint'),
                         ('tag', 'bigint'),
                         ('ac_cumsum_part_tag', 'bigint'),
                         ('r_cumcnt_part_tag', 'bigint'),
                         ('l_cumcnt_part_tag', 'bigint'),
                         ('pqet_cumsum_part_tag', 'bigint')],
 'user_sample': [('row_id', 'bigint'), ('user_id', 'bigint'), ('task_container_id', 'bigint')],
 'user_sequences': [('user_id', 'bigint'),
                    ('seq_chunk', 'bigint'),
                    ('content_id', 'string'),
                    ('answered_correctly', 'string')],
 'user_tag_state': [('user_id', 'bigint'),
                    ('tag', 'bigint'),
                    ('ac_cumsum_tag', 'bigint'),
                    ('r_cumcnt_tag', 'bigint'),
                    ('l_cumcnt_tag', 'bigint'),
                    ('pqet_cumsum_tag', 'bigint')],
 'vocabulary': [('content_id', 'bigint'), ('code', 'bigint')],
 'write_state_snapshot': [('table_name', 'string'),
                          ('table_columns', 'string'),
                          ('feature_columns', 'string')],
 'zero_lecture_answers': [('row_id', 'bigint'), ('answered_correctly', 'bigint')]}
